"""A thin command line over the curation pipeline: python -m granary.cli COMMAND --help.

Every stage reads what the stage before wrote to the work folder. The command line itself is offline: responses
come from the cache, image bytes from a table; a program that has a network passes its own callables to the functions below.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import human_bytes
from granary.operators import claims, domain, nested, promote, store
from granary.plans import pool as P
from granary.session import cut, local_session
from granary.sources import fetching, files, tables

UNKNOWN_DOMAIN, UNAVAILABLE_DOMAIN, NOT_IMPLEMENTED, SOURCE_ERROR, MISSING, LOCKED, STALE, STORE_ERROR, NO_CLAIMS = range(2, 11)
VERSION = 1
PHOTO = "struct<place:int,bucket:string,observation_id:bigint,observer:string,observer_name:string,agreements:int,photo:struct<id:bigint,license_code:string,original_dimensions:struct<width:int,height:int>,url:string>>"
POOL = f"version int, ord struct<ord:bigint,place:int>, id bigint, name string, rank string, count bigint, common_name string, genus string, family string, n_photos bigint, months_represented bigint, distinct_observers bigint, photos array<{PHOTO}>"
RESOLVED = "version int, taxon_id bigint, place int, bucket string, observer string, photo_id bigint, sha256 string"
PROFILE = domain.Profile(500, 75, "WEBP", "codec 1")


class Exit(Exception):
    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def _domain(slug: str) -> domain.Domain:
    try:
        return domain.resolve_domain(slug)
    except domain.UnknownDomain as e:
        raise Exit(UNKNOWN_DOMAIN, str(e)) from e
    except domain.UnavailableDomain as e:
        raise Exit(UNAVAILABLE_DOMAIN, str(e)) from e


def _stage(spark: SparkSession, path: str, schema: str, before: str) -> DataFrame:
    try:
        rows = cut(tables.read_nested(spark, path, schema))
    except tables.MissingTable as e:
        raise Exit(MISSING, f"nothing at {path}; run {before} first") from e
    except tables.StaleTable as e:
        raise Exit(STALE, f"{e}; run {before} again, what it needs is cached") from e
    if not rows.filter(~F.col("version").eqNullSafe(F.lit(VERSION))).isEmpty():
        raise Exit(STALE, f"{path} is of another version; run {before} again")
    return rows.drop("version")


def _entries(spark: SparkSession, cache: str, endpoint: str) -> DataFrame:
    """The responses of an endpoint, of one request the last; ord tells which of several is later: by the time they were fetched, then by key."""
    rows = fetching.cached(spark, cache).filter((F.col("endpoint") == endpoint) & (F.col("projection_version") == VERSION))
    rows = cut(claims.last_wins(rows.withColumn("_at", F.struct("fetched_at", "response")), ["key"], "_at").select("*", F.struct("fetched_at", "key").alias("ord")).drop("_at"))
    if rows.isEmpty():
        raise Exit(SOURCE_ERROR, f"{cache} has no responses of {endpoint}")
    return rows


def fetch(spark: SparkSession, a) -> str:
    """Ranks, filters and samples candidates from cached responses; writes the pool and its ledger."""
    _domain(a.domain)
    counts, details, seen = (_entries(spark, a.cache, e) for e in ("species_counts", "taxa_by_id", "observations"))
    summaries, skipped = P.ranked_summaries(counts.select(F.col("params")["page"].cast("long").alias("ord"), "response"))
    known = claims.last_wins(P.taxon_details(details), ["id"], "ord")
    hits = F.posexplode(nested.project(F.col("response"), "observations")["results"]).alias("ord", "o")
    rows = seen.select(F.col("params")["taxon_id"].cast("long").alias("taxon_id"), F.col("params")["bucket"].alias("bucket"), hits)
    pool = P.candidate_pool(summaries, known, rows.select("taxon_id", "bucket", F.col("ord").cast("long").alias("ord"), "o.*"), a.limit)
    faults = P.pool_violations(pool).take(3)
    if faults:
        raise Exit(SOURCE_ERROR, f"the pool breaks {faults}")
    photos = pool.photos.groupBy("taxon_id").agg(F.array_sort(F.collect_list(F.struct(*[x.split(":")[0] for x in ("place", "bucket", "observation_id", "observer", "observer_name", "agreements", "photo")]))).alias("photos"))
    taxa = cut(pool.taxa.join(photos, F.col("id") == F.col("taxon_id")).drop("taxon_id").withColumn("version", F.lit(VERSION)))
    path = domain.artefact(a.work, "candidates", a.state)
    with files.lock(spark, path + "_lock", force=a.force):
        files.commit(taxa, path)
        tables.write_ledger(pool.drops, domain.artefact(a.work, "dropped", a.state), "name")
    return f"wrote {path}\n{taxa.count()} candidates, {pool.drops.count()} dropped, {skipped.first().skipped} unreadable"


def _pool(spark: SparkSession, a) -> P.Pool:
    rows = _stage(spark, domain.artefact(a.work, "candidates", a.state), POOL, "fetch")
    photos = rows.select(F.col("id").alias("taxon_id"), F.explode("photos").alias("p")).select("taxon_id", "p.*")
    drops = tables.read_ledger(spark, domain.artefact(a.work, "dropped", a.state)).select(F.col("id").cast("long").alias("id"), "name", "reason", "detail")
    return P.Pool(rows.drop("photos"), cut(photos), cut(drops))


def resolve(spark: SparkSession, a) -> str:
    """Stores the candidates' image bytes by content; reuses what earlier runs settled."""
    pool, path, images = _pool(spark, a), domain.artefact(a.work, "resolved", a.state), f"{a.store}/images"
    try:
        files.claim_folder(spark, a.store, "store", PROFILE._asdict())
    except files.FormatError as e:
        raise Exit(STORE_ERROR, str(e)) from e
    settled = spark.createDataFrame([], "taxon_id long, photo_id long, sha256 string, reason string")
    if files.exists(spark, path):
        settled = _stage(spark, path, RESOLVED, "resolve").select("taxon_id", "photo_id", "sha256", F.lit(None).cast("string").alias("reason"))
    answers = spark.read.schema("url string, status int, content_type string, content binary").parquet(a.responses)
    resolved, drops, counters = P.resolve_pool(pool, lambda asked: answers.join(asked, "url", "left_semi"), settled, settled.filter("sha256 IS NOT NULL").select("photo_id", "sha256").distinct())
    wanted = resolved.select("sha256").distinct()
    store.write_contents(store.addressed(answers.select("content"), "content").join(wanted, "sha256", "left_semi"), images)
    with files.lock(spark, path + "_lock", force=a.force):
        files.commit(resolved.withColumn("version", F.lit(VERSION)), path)
        tables.write_ledger(drops, domain.artefact(a.work, "lost", a.state), "taxon_id")
    c = counters.first()
    return f"wrote {path}\n{c.stored} photos of {c.distinct_contents} contents, {c.fetched} fetched, {c.failures} lost, {c.deduped} of them duplicates, {c.taxa_reused} taxa reused"


def gc(spark: SparkSession, a) -> str:
    """Finds stored images that no resolved pool refers to, and deletes them unless it is a dry run."""
    images = f"{a.store}/images"
    try:
        files.claim_folder(spark, a.store, "store", PROFILE._asdict())
    except files.FormatError as e:
        raise Exit(STORE_ERROR, str(e)) from e
    pools = [_stage(spark, domain.artefact(a.work, "resolved", s), RESOLVED, "resolve") for s in a.states]
    gone = store.collect(spark, images, P.referenced(pools) if pools else spark.createDataFrame([], "sha256 string"), a.dry_run)
    size = tables.directory_size(spark, images).select(human_bytes(F.col("bytes")).alias("size")).first().size
    return f"{gone.count()} unreferenced in {a.store}, {size} now\n" + ("dry run: nothing deleted" if a.dry_run else "deleted")


def promote_pack(spark: SparkSession, a) -> str:
    """Decides every taxon's claim from two sources and writes the manifest, the unmatched taxa and the audit."""
    pool = _pool(spark, a)
    resolved = _stage(spark, domain.artefact(a.work, "resolved", a.state), RESOLVED, "resolve")
    taxa = cut(pool.taxa.join(resolved.select(F.col("taxon_id").alias("id")).distinct(), "id", "left_semi"))
    hits = "array<struct<symbol:string,name:string,accepted_symbol:string,is_synonym:boolean,binomial:string,is_infraspecific:boolean>>"
    found = _entries(spark, a.second_cache, "search").select("ord", F.posexplode(F.from_json("response", f"struct<results:{hits}>")["results"]).alias("place", "r"))
    records = claims.last_wins(found.select(F.struct("ord", "place").alias("ord"), "r.*"), ["symbol"], "ord").drop("ord")
    listed = "struct<symbol:string,native_statuses:array<struct<region:string,status:string>>>"
    profiles = _entries(spark, a.second_cache, "profile").select("ord", F.from_json("response", listed).alias("p")).select("ord", "p.symbol", F.posexplode("p.native_statuses").alias("place", "s"))
    statuses = profiles.select("symbol", F.struct("ord", "place").alias("pos"), "s.*")
    matched = P.reconcile(taxa.select("id", "name"), records, statuses)
    details = P.taxon_details(_entries(spark, a.cache, "taxa_by_id"))
    listed_at = cut(P.establishment(taxa.select("id"), details, a.place))
    version = fetching.file_version(spark, a.second_cache).first().version
    first = domain.retrieved_ref("records", "https://records.invalid", F.lit(str(version)).cast("timestamp"))
    second = domain.checklist_ref("checklist", "https://places.invalid", F.lit(a.state.upper()), F.current_timestamp())
    decisions = cut(P.decide(matched, listed_at, first, second))
    policy = promote.for_state(tables.read_policy(spark, a.exclusions, "state string, id long, name string, reason string, source string", "state"), a.state) if a.exclusions else None
    policy = policy if policy is not None else spark.createDataFrame([], "id long, name string, reason string, source string")
    demotions = tables.read_policy(spark, a.demotions, "genus string") if a.demotions else spark.createDataFrame([], "genus string")
    promoted, _ = P.manifest(taxa, resolved, decisions, policy.select("id"), demotions)
    promoted = cut(promoted)
    unmatched = promote.unmatched_details(taxa.join(promoted.select("id"), "id", "left_anti").select("id", "name"), "id", "name", policy, decisions.filter("reason IS NOT NULL").select("id", "reason", F.col("reason").alias("detail")))
    tables.write_ledger(cut(unmatched), domain.artefact(a.work, "unmatched", a.state), "name")
    why = decisions.filter("reason IS NOT NULL").select("id", "reason")
    decided = promote.answer_rank(promote.promote(taxa.select("id", "name", "genus"), "id", policy.select("id"), decisions.filter("value IS NOT NULL").select("id", "value"), why), demotions, "genus")
    fused = decisions.select("id", "outcome").join(matched.select("id", F.col("value").alias("first")), "id").join(listed_at.select("id", F.col("value").alias("second")), "id")
    report = cut(promote.report(decided, matched, fused, taxa))
    files.commit(report, domain.artefact(a.work, "promotion", a.state))
    path = domain.artefact(a.packs, "manifest", a.state)
    try:
        tables.write_nonempty(promoted.withColumn("version", F.lit(VERSION)), path)
    except ValueError as e:
        raise Exit(NO_CLAIMS, f"no taxon got a claim, so there is no pack; see {domain.artefact(a.work, 'unmatched', a.state)}") from e
    return f"wrote {path}\n{claims.fusion_summary(decisions).first().line}\n{promote.summary(promote.counters(decided)).first().line}"


def places(spark: SparkSession, a) -> str:
    """Writes every state's place id, or nothing if one has none."""
    states = spark.createDataFrame([tuple(x.split("=", 1)) for x in a.states], "code string, name string")
    hits = nested.project(F.col("response"), "places_autocomplete")["results"]
    found = _entries(spark, a.cache, "places_autocomplete").select(F.col("params")["q"].alias("name"), hits.alias("results"))
    try:
        tables.refreshed_places(states, found, a.out)
    except LookupError as e:
        raise Exit(SOURCE_ERROR, str(e)) from e
    return f"wrote {a.out}"


def _lines(found: dict[str, DataFrame]) -> list[str]:
    """Statistics as text, a section each, rows sorted; what wasn't measured reads n/a and not 0."""
    show = lambda v: "n/a" if v is None else f"{v:.0f}" if isinstance(v, float) else str(v)
    out = []
    for name, df in found.items():
        rows = sorted((tuple(map(show, r)) for r in df.collect()), key=str)  # a few rows each: vocabularies and single figures
        if len(rows) == 1 and df.dtypes[0][1] != "string":
            out.append(f"{name}: " + ", ".join(f"{c} {v}" for c, v in zip(df.columns, rows[0])))
        else:
            out += [f"{name}:", *[f"  {r[0]}: {', '.join(r[1:])}" if len(r) > 1 else f"  {r[0]}" for r in rows]] if rows else [f"{name}: (none)"]
    return out


def stats(spark: SparkSession, a) -> str:
    """The statistics of a stage's result."""
    if a.stage == "pool":
        return "\n".join(_lines(P.pool_statistics(_pool(spark, a))))
    if a.stage == "resolved":
        resolved = _stage(spark, domain.artefact(a.work, "resolved", a.state), RESOLVED, "resolve")
        drops = tables.read_ledger(spark, domain.artefact(a.work, "lost", a.state))
        stored = store.stored(spark, f"{a.store}/images")
        sizes = stored.select("sha256", F.octet_length("content").alias("bytes")) if stored is not None else resolved.select("sha256", F.lit(None).cast("int").alias("bytes")).distinct()
        return "\n".join([*_lines(P.resolved_statistics(resolved, drops, sizes)), f"store on disk: {tables.directory_size(spark, a.store).select(human_bytes(F.col('bytes')).alias('s')).first().s}"])
    path = domain.artefact(a.packs, "manifest", a.state)
    if not files.exists(spark, path):
        raise Exit(MISSING, f"nothing at {path}; run promote-pack first")
    promoted = cut(spark.read.json(path))
    ledger = domain.artefact(a.work, "unmatched", a.state)
    unmatched = tables.drop_reasons(tables.read_ledger(spark, ledger)) if files.exists(spark, ledger) else spark.createDataFrame([], "reason string")
    audit = domain.artefact(a.work, "promotion", a.state)
    written = tables.report_lines(tables.read_report(spark.read.text(audit), "value")) if files.exists(spark, audit) else []
    return "\n".join([*_lines(P.manifest_statistics(promoted, unmatched)), *written])


def build(spark: SparkSession, a) -> str:
    """Checks that there is a pool, and says that promotion is a command of its own."""
    pool = _pool(spark, a)
    raise Exit(NOT_IMPLEMENTED, f"{pool.taxa.count()} candidates, but no claims and no images yet: run resolve and promote-pack")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="granary", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name, run, *options):
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for flag, how in options:
            sub.add_argument(flag, **how)

    state, work, force = ("--state", {"required": True}), ("--work", {"default": "work"}), ("--force", {"action": "store_true"})
    cache, kept, packs = ("--cache", {"default": "cache"}), ("--store", {"default": "images"}), ("--packs", {"default": "packs"})
    command("fetch", fetch, ("--domain", {"default": "plants"}), state, ("--limit", {"type": int, "default": 300}), cache, work, force)
    command("stats", stats, state, ("--stage", {"choices": ("pool", "resolved", "manifest"), "default": "pool"}), work, kept, packs)
    command("places", places, ("--states", {"nargs": "+", "required": True}), ("--out", {"required": True}), cache)
    command("resolve", resolve, state, work, kept, ("--responses", {"required": True}), force)
    command("gc", gc, ("--states", {"nargs": "*", "default": []}), work, kept, ("--no-dry-run", {"dest": "dry_run", "action": "store_false"}))
    command("promote-pack", promote_pack, state, work, packs, cache, ("--second-cache", {"default": "second"}), ("--place", {"type": int, "required": True}), ("--exclusions", {}), ("--demotions", {}))
    command("build", build, state, work)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a command; its exit code tells what kind of failure ended it."""
    a = parser().parse_args(arguments)
    try:
        print(a.run(spark or local_session(app="granary-cli"), a))
    except Exit as e:
        print(f"error: {e}", file=sys.stderr)
        return e.code
    except files.LockedError as e:
        print(f"error: {e}", file=sys.stderr)
        return LOCKED
    return 0


if __name__ == "__main__":
    sys.exit(main())
