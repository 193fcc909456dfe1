"""The command line, stage by stage, on a small hand-made state."""

import json

import pytest

from granary import cli


def entry(path, name, endpoint, params, response):
    path.mkdir(parents=True, exist_ok=True)
    row = {"key": name, "endpoint": endpoint, "params": params, "projection_version": 1, "fetched_at": "2026-01-01T00:00:00Z", "response": json.dumps(response)}
    (path / f"{name}.json").write_text(json.dumps(row) + "\n")


def taxon(i, name, means):
    return {"id": i, "name": name, "ancestors": [{"rank": "genus", "name": name.split()[0]}, {"rank": "family", "name": "f"}], "establishment_means": means}


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("home")
    first, second = home / "cache" / "entries", home / "second" / "entries"
    names = {1: "Acer campestre", 2: "Mentha x lost", 3: "Carex riparia", 4: "Robinia viscosa", 5: "Tilia thin"}
    hits = [{"count": 900 - i, "taxon": {"id": i, "name": n, "rank": "species", "preferred_common_name": n.lower()}} for i, n in names.items()] + [{"count": 1, "taxon": {"id": 9}}, 7]
    entry(first, "counts", "species_counts", {"page": "1"}, {"results": hits})
    here = {"id": 29, "name": "Michigan", "admin_level": 10}
    means = {1: {"establishment_means": "native", "place": here}, 3: None, 4: {"establishment_means": "introduced", "place": here}, 5: None}
    entry(first, "taxa", "taxa_by_id", {"ids": "1,3,4,5"}, {"results": [taxon(i, names[i], m) for i, m in means.items()]})
    for i in (1, 3, 4, 5):
        for b, bucket in enumerate("ABCD"):
            seen = [
                {"id": i * 100 + b * 10 + k, "uri": "u", "num_identification_agreements": 1, "user": {"login": f"u{b}{k}", "name": ""},
                 "photos": [{"id": i * 1000 + b * 10 + k, "license_code": "CC-BY", "original_dimensions": {"width": 5, "height": 5}, "url": f"https://h/{i * 1000 + b * 10 + k}/square.jpg"}]}
                for k in range(2 if i != 5 else b == 0)
            ]
            entry(first, f"seen{i}{bucket}", "observations", {"taxon_id": str(i), "bucket": bucket}, {"results": seen})
    entry(first, "place", "places_autocomplete", {"q": "Michigan"}, {"results": [{"id": 29, "name": "Michigan", "admin_level": 10, "ancestor_place_ids": [1, 29]}]})
    for i, symbol, status in ((1, "ACRU", "N"), (3, "CAIN", "N"), (4, "ROPS", "N")):
        record = {"symbol": symbol, "name": names[i], "accepted_symbol": None, "is_synonym": False, "binomial": names[i], "is_infraspecific": False}
        entry(second, f"s{i}", "search", {"q": names[i]}, {"results": [record]})
        entry(second, f"p{i}", "profile", {"q": symbol}, {"symbol": symbol, "native_statuses": [{"region": "L48", "status": "I"}, {"region": "L48", "status": status}]})
    answers = [(f"https://h/{i * 1000 + b * 10 + k}/medium.jpg", 404 if i == 1 and b == k == 0 else 200, "image/jpeg", f"{i}{b}{k}".encode()) for i in (1, 3, 4) for b in range(4) for k in range(2)]
    spark.createDataFrame(answers, "url string, status int, content_type string, content binary").write.parquet(str(home / "answers"))
    (home / "exclusions.json").write_text(json.dumps([{"state": "mi", "id": 3, "name": "Carex old", "reason": "sedge", "source": "list"}]))
    (home / "demotions.json").write_text(json.dumps([{"genus": "Acer"}]))
    return home


@pytest.fixture(scope="module")
def run(spark, home):
    at = lambda flag, name: [f"--{flag}", str(home / name)]

    def call(command, *more, state=True):
        folders = {
            "fetch": at("cache", "cache") + at("work", "work"), "stats": at("work", "work") + at("store", "store") + at("packs", "packs"), "resolve": at("work", "work") + at("store", "store") + at("responses", "answers"),
            "gc": at("work", "work") + at("store", "store"), "promote-pack": at("work", "work") + at("packs", "packs") + at("cache", "cache") + at("second-cache", "second"), "build": at("work", "work"), "places": at("cache", "cache"),
        }[command]
        return cli.main([command, *folders, *(["--state", "mi"] if state else []), *more], spark)

    return call


def test_stages(spark, home, run, capsys):
    assert run("build") == cli.MISSING and run("resolve") == cli.MISSING
    assert run("fetch", "--domain", "fish") == cli.UNKNOWN_DOMAIN and run("fetch", "--domain", "birds") == cli.UNAVAILABLE_DOMAIN
    assert cli.main(["fetch", "--state", "mi", "--cache", str(home / "none"), "--work", str(home / "w")], spark) == cli.SOURCE_ERROR
    capsys.readouterr()
    assert run("fetch", "--limit", "10") == 0
    assert "3 candidates, 2 dropped, 2 unreadable" in capsys.readouterr().out
    assert run("build") == cli.NOT_IMPLEMENTED and run("stats", "--stage", "manifest") == cli.MISSING
    assert run("stats") == 0
    out = capsys.readouterr().out
    assert "considered: kept 3, dropped 2, considered 5" in out and "  hybrid: 1" in out and "  below_observation_floor: 0" in out and "observations: median 897, p10 896" in out

    assert run("resolve") == 0
    assert "23 photos of 23 contents, 24 fetched, 1 lost, 0 of them duplicates, 0 taxa reused" in capsys.readouterr().out
    assert run("resolve") == 0  # the taxa whose photos are all settled are taken over
    assert "2 taxa reused" in capsys.readouterr().out
    assert run("stats", "--stage", "resolved") == 0
    out = capsys.readouterr().out
    assert "images: taxa 3, images 23, distinct_contents 23" in out and "  not_found: 1" in out and "bytes: median 3, p10 3" in out

    assert run("gc", "--states", "mi", state=False) == 0
    assert "0 unreferenced" in capsys.readouterr().out
    more = ["--place", "29", "--exclusions", str(home / "exclusions.json"), "--demotions", str(home / "demotions.json")]
    assert run("promote-pack", *more) == 0
    assert "1 promoted, 2 unmatched, 1 genus-demoted, 1 excluded" in capsys.readouterr().out
    pack = spark.read.json(str(home / "packs" / "manifest_MI")).collect()
    assert [(r.name, r.answer_rank, r.claim.value, r.claim.confidence, len(r.claim.sources), len(r.image_hashes)) for r in pack] == [("Acer campestre", "genus", "native", "high", 2, 7)]
    unmatched = {r.name: (r.reason, r.detail) for r in spark.read.option("header", True).csv(str(home / "work" / "unmatched_MI")).collect()}
    assert unmatched["Robinia viscosa"][0] == "source_conflict" and unmatched["Carex riparia"][0] == "curated_exclusion" and "made for 'Carex old'" in unmatched["Carex riparia"][1]
    audit = spark.read.json(str(home / "work" / "promotion_MI")).first()
    assert (audit.promoted, audit.unmatched, audit.agreement, audit.no_source, audit.demoted, audit.excluded) == (1, 2, 1, 0, ["Acer campestre"], ["Carex riparia"])
    assert [tuple(x) for x in audit.conflicts] == [("Robinia viscosa", "native", "introduced")] or {x.name for x in audit.conflicts} == {"Robinia viscosa"}
    assert run("stats", "--stage", "manifest") == 0
    assert "cards: taxa 1, images 7" in capsys.readouterr().out
    assert run("promote-pack", "--place", "40", "--exclusions", str(home / "exclusions.json")) == 0  # another place's answers aren't used


def test_faults_have_their_exit_codes(spark, home, run, tmp_path):
    assert run("places", "--states", "MI=Michigan", "OH=Ohio", "--out", str(tmp_path / "p"), state=False) == cli.SOURCE_ERROR and not (tmp_path / "p").exists()
    assert run("places", "--states", "MI=Michigan", "--out", str(tmp_path / "p"), state=False) == 0
    work = tmp_path / "work"
    (work / "candidates_MI").mkdir(parents=True)
    (work / "candidates_MI" / "part-0.json").write_text('{"id": 1, "colour": "red"}\n')
    assert cli.main(["build", "--state", "mi", "--work", str(work)], spark) == cli.STALE
    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "x").write_text("not ours")
    assert cli.main(["gc", "--store", str(tmp_path / "store"), "--work", str(work)], spark) == cli.STORE_ERROR
    from granary.sources import files

    with files.lock(spark, str(home / "work" / "candidates_MI") + "_lock"):
        assert run("fetch") == cli.LOCKED
        assert run("fetch", "--force") == 0
    (home / "work" / "empty").mkdir()
    nothing = home / "second" / "entries"
    for f in nothing.glob("p*.json"):
        f.write_text(f.read_text().replace('\\"N\\"', '\\"GP\\"'))
    assert run("promote-pack", "--place", "40") == cli.NO_CLAIMS
