"""Projections of nested JSON that keep absence apart from emptiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import parse_name, strip_tags
from granary.operators import guards

#: Element schemas of the cached endpoints' results.
SCHEMAS = {
    "observations": "struct<id:bigint,uri:string,num_identification_agreements:int,user:struct<login:string,name:string>,"
    "photos:array<struct<id:bigint,license_code:string,original_dimensions:struct<width:int,height:int>,url:string>>>",
    "species_counts": "struct<count:bigint,taxon:struct<id:bigint,name:string,rank:string,preferred_common_name:string>>",
    "taxa_by_id": "struct<id:bigint,name:string,ancestors:array<struct<rank:string,name:string>>,"
    "establishment_means:struct<establishment_means:string,place:struct<id:bigint,name:string,admin_level:int>>>",
    "places_autocomplete": "struct<id:bigint,name:string,admin_level:int,ancestor_place_ids:array<bigint>>",
}


def project(body: Column, endpoint: str) -> Column:
    """The endpoint's fields of a response: results keep their number and order, what is no object is null; missing results are empty.

    A field of another kind than the endpoint's is null, as if it weren't there.
    """
    parsed = F.try_parse_json(body)
    element = T._parse_datatype_string(SCHEMAS[endpoint])
    results = guards.read(guards.at(parsed, "results"), T.ArrayType(element))
    total = guards.read(guards.at(parsed, "total_results"), T.LongType())
    return F.struct(total.alias("total_results"), F.coalesce(results, F.array().cast(T.ArrayType(element))).alias("results"))


def ancestor(ancestors: Column, rank: str) -> Column:
    """The first ancestor of a rank with a name."""
    return F.try_element_at(F.filter(ancestors, lambda a: (a["rank"] == rank) & (F.length(a["name"]) > 0)), F.lit(1))["name"]


def plant_record(symbol: Column, name: Column, accepted: Column, synonym_symbol: Column) -> Column:
    """A second-source hit; null without symbol or name. It is a synonym if it names one or is accepted under another symbol."""
    filled = lambda c: F.nullif(c, F.lit("")).isNotNull()
    is_synonym = filled(synonym_symbol) | filled(accepted) & (accepted != symbol)
    row = F.struct(symbol.alias("symbol"), name.alias("name"), F.nullif(accepted, F.lit("")).alias("accepted_symbol"), F.coalesce(is_synonym, F.lit(False)).alias("is_synonym"))
    return F.when(filled(symbol) & filled(name), row)


def detail(taxon: Column) -> Column:
    """id, genus and family of a projected taxon; null without an id."""
    named = lambda rank: ancestor(taxon["ancestors"], rank).alias(rank)
    return F.when(taxon["id"].isNotNull(), F.struct(taxon["id"].alias("id"), named("genus"), named("family")))


def summary(hit: Column) -> Column:
    """id, name, rank, count and common name of a projected count; null, so no row, if one of the first four is missing, empty or out of range."""
    t = hit["taxon"]
    row = F.struct(t["id"].alias("id"), t["name"].alias("name"), t["rank"].alias("rank"), hit["count"].alias("count"), F.nullif(t["preferred_common_name"], F.lit("")).alias("common_name"))
    return F.when((t["id"] >= 1) & (t["name"] != "") & (t["rank"] != "") & (hit["count"] >= 0), row)


def search_hits(hits: Column) -> Column:
    """plant_record of an array of raw hits (Symbol, ScientificName, AcceptedSymbol, SynonymSymbol), those without symbol or binomial left out."""
    def record(x):
        parsed = parse_name(x["ScientificName"])
        row = plant_record(x["Symbol"], strip_tags(x["ScientificName"]), x["AcceptedSymbol"], x["SynonymSymbol"])
        return F.when(parsed["binomial"].isNotNull() & row.isNotNull(), row.withField("binomial", parsed["binomial"]).withField("is_infraspecific", parsed["is_infraspecific"]))

    return F.array_compact(F.transform(F.coalesce(hits, F.array().cast("array<struct<Symbol:string,ScientificName:string,AcceptedSymbol:string,SynonymSymbol:string>>")), record))


def profile(symbol: Column, name: Column, statuses: Column) -> Column:
    """A second-source profile: symbol, name without markup, and region and status of each native status that has a region."""
    listed = F.transform(F.filter(F.coalesce(statuses, F.array().cast("array<struct<Region:string,Status:string>>")), lambda x: F.length(x["Region"]) > 0), lambda x: F.struct(x["Region"].alias("region"), x["Status"].alias("status")))
    return F.struct(symbol.alias("symbol"), strip_tags(name).alias("scientific_name"), listed.alias("native_statuses"))


def state_place(results: Column, name: Column | str, level: int = 10, country: int = 1) -> Column:
    """The id of the first place of that level, in that country, of exactly that name."""
    fits = lambda p: (p["admin_level"] == level) & F.array_contains(p["ancestor_place_ids"], country) & (p["name"] == name)
    return F.try_element_at(F.filter(results, fits), F.lit(1))["id"]


def usable_photos(photos: Column, licenses: tuple[str, ...] = ("cc0", "cc-by", "cc-by-sa"), needs: tuple[str, ...] = ()) -> Column:
    """The first usable photo in list order, with its licence in lower case; an array of one or none.

    Usable means an allowed licence and what is needed of id, url (no empty one) and original_dimensions (positive ones).
    """
    def usable(p):
        ok = F.lower(p["license_code"]).isin(*licenses)
        if "id" in needs:
            ok &= p["id"].isNotNull()
        if "url" in needs:
            ok &= F.length(p["url"]) > 0
        if "original_dimensions" in needs:
            ok &= (p["original_dimensions"]["width"] > 0) & (p["original_dimensions"]["height"] > 0)
        return ok

    return F.transform(F.slice(F.filter(photos, usable), 1, 1), lambda p: p.withField("license_code", F.lower(p["license_code"])))


def usable_photo(photos: Column, licenses: tuple[str, ...] = ("cc0", "cc-by", "cc-by-sa"), needs: tuple[str, ...] = ()) -> Column:
    return F.get(usable_photos(photos, licenses, needs), F.lit(0))


def agreement_count(n: Column) -> Column:
    """A missing or negative count is 0."""
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0))


def download_class(status: Column, content_type: Column, size: Column) -> Column:
    """ok, or the first fault of a response."""
    return (
        F.when(status == 404, "not_found").when(status != 200, "http_error")
        .when(~F.coalesce(F.lower(content_type).startswith("image/"), F.lit(False)), "not_an_image").when(F.coalesce(size, F.lit(0)) == 0, "empty_body").otherwise("ok")
    )
