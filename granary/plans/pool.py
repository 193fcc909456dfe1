"""The curation pipeline set at a time: candidate pool, resolution, nativity decisions, manifest, statistics."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import sized_url
from granary.operators import claims, constraints, deck, ledger, nested, promote, sampling, stats, store
from granary.session import cut

MIN_COUNT, FLOOR, RESOLVED_FLOOR, MOST = 50, 4, 4, 8
# The closed vocabularies of reasons.
CANDIDATE_REASONS = ("hybrid", "not_species_rank", "below_observation_floor", "taxon_detail_unavailable", "insufficient_licensed_photos")
RESOLVE_REASONS = ("not_found", "http_error", "not_an_image", "empty_body", "duplicate_content", "insufficient_resolved_photos")


class Pool(NamedTuple):
    """taxa, photos (in the order they were chosen) and the ledger of dropped taxa."""

    taxa: DataFrame
    photos: DataFrame
    drops: DataFrame


def photo_signals() -> dict[str, Column]:
    """What a taxon's photos say about it."""
    return {"n_photos": F.count(F.lit(1)), "months_represented": F.count_distinct("bucket"), "distinct_observers": F.count_distinct("observer")}


def is_hybrid(rank: Column, name: Column) -> Column:
    lowered = F.lower(name)
    return (rank == "hybrid") | lowered.contains("×") | lowered.contains(" x ") | lowered.contains("hybrid")


def select_taxa(summaries: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(kept, drops) of ranked summaries (ord, id, name, rank, count): of a repeated id the first counts, rows behind the one that fills the limit don't."""
    first = deck.first_occurrence(summaries.filter("id IS NOT NULL AND name IS NOT NULL AND rank IS NOT NULL AND count IS NOT NULL"), ["id"], [F.col("ord")])
    reason = ledger.first_reason(
        (is_hybrid(F.col("rank"), F.col("name")), "hybrid"), (F.col("rank") != "species", "not_species_rank"), (F.col("count") < MIN_COUNT, "below_observation_floor")
    )
    kept, dropped = ledger.split(cut(deck.ranked_prefix(first.withColumn("reason", reason), "ord", "reason", limit)))
    detail = F.format_string("%s: rank %s, %d observations", "name", "rank", "count")
    return kept, dropped.select("id", "name", "reason", detail.alias("detail"))


def usable_observations(observations: DataFrame) -> DataFrame:
    """taxon_id, bucket, observation_id, observer and the first usable photo; observations without one are left out.

    observations: taxon_id, bucket, ord and the projected fields. Where the photos come with their dimensions, or the observation with
    its address, these must be there. An observation in several buckets counts in the first one.
    """
    needs = [k for k in observations.schema["photos"].dataType.elementType.fieldNames() if k != "license_code"]
    given = F.col("id").isNotNull() & (F.length("user.login") > 0) & (F.length("uri") > 0 if "uri" in observations.columns else F.lit(True))
    rows = observations.filter(given).select("taxon_id", "bucket", "ord", F.col("id").alias("observation_id"), F.col("user.login").alias("observer"), F.nullif("user.name", F.lit("")).alias("observer_name"),
                               nested.agreement_count(F.col("num_identification_agreements")).alias("agreements"), "photos")
    # one row or none: the photo is looked for once, and not in every filter that Spark makes of it
    rows = rows.select("*", F.explode(nested.usable_photos(F.col("photos"), needs=tuple(needs))).alias("photo")).drop("photos")
    return deck.first_occurrence(rows, ["taxon_id", "observation_id"], [F.col("bucket"), F.col("ord")])


def candidate_pool(summaries: DataFrame, details: DataFrame, observations: DataFrame, limit: int) -> Pool:
    """Ranks, filters and samples. Twice as many summaries as wanted are considered, as later stages lose some.

    A summary without detail and one with fewer than FLOOR photos are dropped with a reason; taxa behind
    the one that fills the limit are neither kept nor dropped at the last stage. Only observations of taxa that got
    so far are looked at: their ids, 2 * limit at most, are sent to the scan.
    """
    kept, drops = select_taxa(summaries, 2 * limit)
    known = details.select(F.col("id").alias("detail_id"), "genus", "family")
    found = cut(kept.join(known, F.col("id") == F.col("detail_id"), "left"))
    lost = F.when(F.col("detail_id").isNull(), "no detail was returned").when(F.col("genus").isNull(), "no genus among the ancestors").when(F.col("family").isNull(), "no family among the ancestors")
    drops = ledger.union_ledgers(drops, found.filter(lost.isNotNull()).select("id", "name", F.lit("taxon_detail_unavailable").alias("reason"), lost.alias("detail")))
    taxa = found.filter(lost.isNull())

    wanted = F.broadcast(taxa.select(F.col("id").alias("wanted_id")).distinct())
    usable = cut(usable_observations(observations.join(wanted, F.col("taxon_id") == F.col("wanted_id"), "left_semi")))
    chosen = sampling.round_robin_capped(usable, "taxon_id", "bucket", "observer", "observation_id", most=MOST)
    flat = chosen.select("taxon_id", F.posexplode("chosen").alias("place", "c")).select("taxon_id", "place", F.col("c.i").alias("observation_id"))
    photos = cut(flat.join(usable, ["taxon_id", "observation_id"]))
    signals = photos.groupBy("taxon_id").agg(*[c.alias(k) for k, c in photo_signals().items()])

    sampled = taxa.join(signals, F.col("id") == F.col("taxon_id"), "left").withColumn("n_photos", F.coalesce("n_photos", F.lit(0)))
    sampled = sampled.withColumn("reason", F.when(F.col("n_photos") < FLOOR, "insufficient_licensed_photos"))
    final, late = ledger.split(cut(deck.short_prefix(sampled, "ord", "reason", limit)))  # 2 * limit rows at most
    drops = drops.unionByName(late.select("id", "name", "reason", F.format_string("%d usable photos", "n_photos").alias("detail")))
    photos = photos.join(final.select(F.col("id").alias("taxon_id")), "taxon_id", "left_semi")
    return Pool(final.drop("detail_id", "taxon_id"), photos, drops)


def pool_violations(pool: Pool) -> DataFrame:
    """All broken constraints of a candidate pool together: one scan of a table and one count for all that is about keys."""
    by_key = constraints.broken(
        [
            constraints.facts(pool.taxa, ("taxon", "left", F.col("id")), ("owner", "right", F.col("id"))),
            constraints.facts(pool.drops, ("taxon", "right", F.col("id"))),
            constraints.facts(pool.photos, ("owner", "left", F.col("taxon_id")), ("observation", "left", F.col("observation_id"))),
        ],
        {
            "duplicate_taxon": ("taxon", constraints.repeated()), "duplicate_drop": ("taxon", constraints.repeated("right")), "kept_and_dropped": ("taxon", constraints.on_both()),
            "photo_of_no_taxon": ("owner", constraints.alone("left")), "repeated_observation": ("observation", constraints.repeated()),
            "photo_count": ("owner", (F.col("n_left") > 0) & ~F.col("n_left").between(FLOOR, MOST)),
        },
    )
    owners = pool.photos.groupBy("taxon_id", "observer").count().filter(F.col("count") > sampling.OWNER_CAP)
    return constraints.all_of(
        by_key, constraints.recomputed(pool.taxa, "id", pool.photos, "taxon_id", photo_signals(), "stale_signals"),
        owners.select(F.lit("observer_cap").alias("constraint"), F.col("taxon_id").cast("string").alias("key")),
    )


def measured(responses: DataFrame) -> DataFrame:
    """url, status, content_type, sha256 and bytes of responses; contents go no further than where they were read."""
    return responses.select("url", "status", "content_type", F.when(F.col("content").isNotNull(), F.sha2("content", 256)).alias("fetched"), F.octet_length("content").alias("bytes"))


def resolve(photos: DataFrame, responses: DataFrame, known: DataFrame, size: str = "medium") -> tuple[DataFrame, DataFrame]:
    """(resolved, drops) of photos against fetched bytes and the ledger of earlier runs.

    responses: url, status, content_type, content, or what measured makes of them. known: photo_id, sha256, from earlier runs, and reused.
    Of equal contents in a taxon the first in candidate order stays. A taxon with too few photos left is
    dropped; a photo's fault is dropped with its class.
    """
    wanted = photos.select("taxon_id", "place", "bucket", "observer", F.col("photo.id").alias("photo_id"), sized_url(F.col("photo.url"), size).alias("url"))
    answers = measured(responses) if "content" in responses.columns else responses
    rows = wanted.join(known.select("photo_id", F.col("sha256").alias("known")), "photo_id", "left").join(answers, "url", "left")
    fault = nested.download_class(F.coalesce("status", F.lit(404)), F.col("content_type"), F.col("bytes"))
    rows = rows.withColumn("reason", F.when(F.col("known").isNull() & (fault != "ok"), fault)).withColumn("sha256", F.when(F.col("reason").isNull(), F.coalesce("known", "fetched")))
    same = F.row_number().over(Window.partitionBy("taxon_id", "sha256").orderBy("place"))
    rows = rows.withColumn("reason", F.when(F.col("reason").isNull() & (same > 1), "duplicate_content").otherwise(F.col("reason")))
    stored, faults = ledger.split(cut(rows))
    counts = wanted.select("taxon_id").distinct().join(stored.groupBy("taxon_id").agg(F.count(F.lit(1)).alias("n")), "taxon_id", "left")
    thin = counts.filter(F.coalesce("n", F.lit(0)) < RESOLVED_FLOOR).select("taxon_id")
    drops = faults.select("taxon_id", "photo_id", "reason").unionByName(thin.select("taxon_id", F.lit(None).cast("long").alias("photo_id"), F.lit("insufficient_resolved_photos").alias("reason")))
    return stored.select("taxon_id", "place", "bucket", "observer", "photo_id", "sha256").join(thin, "taxon_id", "left_anti"), drops


def establishment(requested: DataFrame, details: DataFrame, place_id: int) -> DataFrame:
    """id, value, reason for every requested id: the last answer of an id counts, and only for the place asked."""
    asked = requested.select("id").distinct()
    answers = claims.last_wins(details.select("id", "ord", "establishment_means").join(asked, "id", "left_semi"), ["id"], "ord")
    means = F.col("establishment_means")
    right_place = means["place"]["id"].eqNullSafe(F.lit(place_id).cast("long"))
    value = F.coalesce(*[F.when(means["establishment_means"] == k, F.lit(v)) for k, v in {"native": "native", "endemic": "native", "introduced": "introduced"}.items()])
    reason = (
        F.when(F.col("found").isNull(), "absent_from_response").when(means.isNull(), "no_listing").when(~right_place, "place_not_state_scoped").when(value.isNull(), "uninterpretable_establishment_means")
    )
    rows = asked.join(answers.withColumn("found", F.lit(True)), "id", "left").withColumn("reason", reason)
    return rows.select("id", F.when(F.col("reason").isNull(), value).alias("value"), "reason")


def reconcile(taxa: DataFrame, records: DataFrame, statuses: DataFrame, region: str = "L48") -> DataFrame:
    """id, tier, symbol, value, confidence, reason: taxa (id, name) matched by name with a source that shares no key.

    records: symbol, binomial, is_infraspecific, accepted_symbol, is_synonym. statuses: symbol, region,
    status, pos. Exact accepted names go before exact synonyms, these before loose names. Homonyms are
    accepted if they agree; of a region given twice the last status counts.
    """
    from granary.functions.text import classify_status, loose_name

    species = records.filter(~F.col("is_infraspecific")).select("symbol", "binomial", "accepted_symbol", "is_synonym")
    met = taxa.select("id", "name").join(species, loose_name(F.col("name")) == loose_name(F.col("binomial")))
    exact = F.col("name") == F.col("binomial")
    best = claims.best_tier(met.withColumn("tier", F.when(exact & ~F.col("is_synonym"), 1).when(exact, 2).otherwise(3)), "id")
    targets = cut(best.select("id", "tier", F.coalesce(F.nullif("accepted_symbol", F.lit("")), F.col("symbol")).alias("target")).distinct())
    asked = targets.select(F.col("target").alias("symbol")).distinct()
    last = claims.last_wins(statuses.filter(F.col("region") == region).join(asked, "symbol", "left_semi"), ["symbol"], "pos")
    valued = targets.join(last.select(F.col("symbol").alias("target"), classify_status(F.col("status")).alias("s")), "target", "left")
    why = F.when(F.col("s").isNull(), "no_native_status").otherwise(F.col("s.reason"))
    valued = valued.select("id", "tier", "target", F.col("s.value").alias("value"), why.alias("why"))
    agreed = claims.consensus(valued, "id", "target", "value").withColumnRenamed("reason", "fault")
    first = valued.select("id", F.col("target").alias("symbol"), "tier", "why")
    out = taxa.select("id").join(agreed.join(first, ["id", "symbol"]), "id", "left")
    reason = F.when(F.col("symbol").isNull(), "no_plants_record").when(F.col("fault") == "ambiguous_match", "ambiguous_plants_match").when(F.col("value").isNull(), F.col("why"))
    confidence = F.when(F.col("value").isNotNull(), F.when(F.col("tier") == 3, "medium").otherwise("high"))
    return cut(out.select("id", F.when(reason.isNull(), F.col("tier")).alias("tier"), "symbol", "value", confidence.alias("confidence"), reason.alias("reason")))


def decide(reconciled: DataFrame, established: DataFrame, first_source: Column, second_source: Column) -> DataFrame:
    """id, outcome, value, confidence, sources, reason of every reconciled taxon, fused with the checklist."""
    listed = established.select("id", F.struct("value", F.lit("high").alias("confidence"), F.array(second_source).alias("sources")).alias("second"))
    rows = reconciled.select("id", F.struct("value", "confidence", F.array(first_source).alias("sources")).alias("first")).join(listed, "id", "left")
    return rows.select("id", *[c.alias(k) for k, c in claims.fuse("first", "second").items()])


def manifest(taxa: DataFrame, images: DataFrame, decisions: DataFrame, exclusions: DataFrame, demotions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(promoted taxa with claim, answer rank and image digests in order, unmatched taxa with reasons)."""
    decided = promote.promote(taxa.select("id", "name", "genus"), "id", exclusions, decisions.filter("value IS NOT NULL").select("id", "value"), decisions.filter("reason IS NOT NULL").select("id", "reason"))
    unmatched = decided.filter("decision = 'unmatched'").select("id", "name", "reason")
    digests = images.groupBy(F.col("taxon_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sha256"))), lambda x: x["sha256"]).alias("image_hashes"))
    kept = decided.filter("decision = 'promoted'").select("id", "name", "genus").join(decisions.select("id", F.struct("value", "confidence", "sources").alias("claim")), "id").join(digests, "id")
    return promote.answer_rank(kept, demotions, "genus"), unmatched


def manifest_violations(taxa: DataFrame, images: DataFrame) -> DataFrame:
    """Dangling and orphan digests, repeated ids and digests, taxa with too few images, claims without sources."""
    held = taxa.select(F.explode("image_hashes").alias("sha256"))
    by_key = constraints.broken(
        [constraints.facts(taxa, ("taxon", "left", F.col("id"))), constraints.facts(held, ("image", "left", F.col("sha256"))), constraints.facts(images, ("image", "right", F.col("sha256")))],
        {
            "duplicate_taxon": ("taxon", constraints.repeated()), "duplicate_image": ("image", constraints.repeated("right")),
            "dangling_image": ("image", constraints.alone("left")), "orphan_image": ("image", constraints.alone("right")),
        },
    )
    rows = {"too_few_images": F.size("image_hashes") >= RESOLVED_FLOOR, "claim_without_source": F.size("claim.sources") >= 1}
    return constraints.all_of(by_key, constraints.checks(taxa, "id", rows))


def taxon_details(bodies: DataFrame) -> DataFrame:
    """id, ord, genus, family and establishment_means of the taxa in cached responses (ord, response); what is no taxon is left out."""
    parsed = bodies.select("ord", F.posexplode(nested.project(F.col("response"), "taxa_by_id")["results"]).alias("place", "t"))
    rows = parsed.select("ord", "place", nested.detail(F.col("t")).alias("d"), F.col("t.establishment_means").alias("establishment_means")).filter("d IS NOT NULL")
    return rows.select("d.id", F.struct("ord", "place").alias("ord"), "d.genus", "d.family", "establishment_means")


def ranked_summaries(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ord, id, name, rank, count, common_name of ranked counts in cached responses, number of entries that couldn't be read)."""
    parsed = bodies.select("ord", F.posexplode(nested.project(F.col("response"), "species_counts")["results"]).alias("place", "hit"))
    rows = parsed.select(F.struct("ord", "place").alias("ord"), nested.summary(F.col("hit")).alias("s"))
    return rows.filter("s IS NOT NULL").select("ord", "s.*"), rows.agg(F.count_if(F.col("s").isNull()).alias("skipped"))


def resolve_pool(pool: Pool, fetch, settled: DataFrame, known: DataFrame, size: str = "medium") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(resolved photos, drops, counters): resolve for what earlier runs haven't settled.

    settled: taxon_id, photo_id, sha256, reason of earlier runs, photos that were stored and those that
    failed. A taxon all of whose photos are settled is taken over as it is. known: photo_id, sha256, contents that any
    run stored. fetch adds status, content_type and content to rows with url, and is asked for each url once.
    """
    wanted = pool.photos.select("taxon_id", F.col("photo.id").alias("photo_id"))
    reuse = store.reusable(wanted, settled, "taxon_id", "photo_id").filter("reuse").select("taxon_id")
    reuse = cut(reuse)
    old = settled.join(reuse, "taxon_id", "left_semi")
    rest = pool.photos.join(reuse, "taxon_id", "left_anti")
    urls = rest.select(F.col("photo.id").alias("photo_id"), sized_url(F.col("photo.url"), size).alias("url"))
    asked = urls.join(known.select("photo_id"), "photo_id", "left_anti").select("url").filter("url IS NOT NULL").distinct()
    responses = cut(measured(fetch(asked)))
    fresh, drops = resolve(rest, responses, known, size)
    kept = pool.photos.select("taxon_id", "place", "bucket", "observer", F.col("photo.id").alias("photo_id"))
    kept = kept.join(old.filter("sha256 IS NOT NULL").select("taxon_id", "photo_id", "sha256"), ["taxon_id", "photo_id"])
    resolved = cut(fresh.unionByName(kept))
    drops = cut(drops.unionByName(old.filter("reason IS NOT NULL").select("taxon_id", "photo_id", "reason")))
    sums = resolved.agg(F.count(F.lit(1)).alias("stored"), F.count_distinct("sha256").alias("distinct_contents"))
    counted = sums.join(reuse.agg(F.count(F.lit(1)).alias("taxa_reused"))).join(responses.agg(F.count(F.lit(1)).alias("fetched"))).join(drops.agg(F.count("photo_id").alias("failures"), F.count_if(F.col("reason") == "duplicate_content").alias("deduped")))
    return resolved, drops, counted


def as_images(resolved: DataFrame) -> DataFrame:
    """Resolved photos as the manifest has them: without the bucket they were picked from."""
    return resolved.drop("bucket", "place", "observer")


def considered(kept: DataFrame, drops: DataFrame, item: str | None = None) -> DataFrame:
    """One row: kept, dropped, considered. Drops that name an item within a taxon (a photo) don't count."""
    of_taxa = drops.filter(F.col(item).isNull()) if item else drops
    counts = kept.agg(F.count(F.lit(1)).alias("kept")).join(of_taxa.agg(F.count(F.lit(1)).alias("dropped")))
    return counts.withColumn("considered", F.col("kept") + F.col("dropped"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    """One row: median (truncated) and p10 (nearest rank); both null for no rows."""
    middle = df.agg(stats.truncated_median(F.col(value)).alias("median"))
    tenth = stats.nearest_rank(df.select(value).withColumn("all", F.lit(1)), ["all"], value, 0.1, "p10").select("p10")
    return middle.join(tenth, F.lit(True), "left")


def pool_statistics(pool: Pool) -> dict[str, DataFrame]:
    """Zero-filled reasons, photos by licence and bucket, and distributions over the pool."""
    depth = pool.photos.groupBy("taxon_id").count()
    return {
        "considered": considered(pool.taxa, pool.drops),
        "reasons": ledger.zero_filled(pool.drops, CANDIDATE_REASONS),
        "licenses": stats.histogram(pool.photos.select(F.col("photo.license_code").alias("license")), "license"),
        "buckets": ledger.zero_filled(pool.photos.select("bucket"), sampling.BUCKETS, "bucket"),
        "thin_rich": depth.agg(F.count_if(F.col("count") <= 5).alias("thin"), F.count_if(F.col("count") > 5).alias("rich")),
        "observations": distribution(pool.taxa, "count"), "months": distribution(pool.taxa, "months_represented"), "observers": distribution(pool.taxa, "distinct_observers"),
    }


def resolved_statistics(resolved: DataFrame, drops: DataFrame, sizes: DataFrame) -> dict[str, DataFrame]:
    """Records and distinct contents, losses by reason, taxa lost, and distributions. sizes: sha256, bytes."""
    measured = resolved.join(sizes.select("sha256", "bytes"), "sha256", "left")
    taxa = resolved.groupBy("taxon_id").agg(*[c.alias(k) for k, c in photo_signals().items()])
    return {
        "images": resolved.agg(F.count_distinct("taxon_id").alias("taxa"), F.count(F.lit(1)).alias("images"), F.count_distinct("sha256").alias("distinct_contents")),
        "losses": ledger.zero_filled(drops, RESOLVE_REASONS), "bytes": distribution(measured, "bytes"),
        "months": distribution(taxa, "months_represented"), "observers": distribution(taxa, "distinct_observers"),
    }


def manifest_statistics(promoted: DataFrame, unmatched: DataFrame) -> dict[str, DataFrame]:
    """Cards, image references, claims by value (with shares), confidence and number of sources, drops by reason, names asked by genus."""
    return {
        "cards": promoted.agg(F.count(F.lit(1)).alias("taxa"), F.coalesce(F.sum(F.size("image_hashes")), F.lit(0)).alias("images")),
        "values": stats.with_share(stats.histogram(promoted.select(F.col("claim.value").alias("value")), "value")),
        "confidence": stats.histogram(promoted.select(F.col("claim.confidence").alias("confidence")), "confidence"),
        "sources": stats.histogram(promoted.select(F.size("claim.sources").alias("sources")), "sources"),
        "unmatched": stats.histogram(unmatched, "reason"),
        "demoted": promoted.filter("answer_rank = 'genus'").select("name"),
    }


def referenced(pools: list[DataFrame]) -> DataFrame:
    """The distinct digests that any of the resolved pools refers to."""
    found = pools[0].select("sha256")
    for x in pools[1:]:
        found = found.union(x.select("sha256"))
    return found.distinct()


def unreferenced(stored: DataFrame, pools: list[DataFrame]) -> DataFrame:
    """Digests of the store that no resolved pool refers to."""
    return store.garbage(stored, referenced(pools))
