"""Domains: what a pack asks besides the name, its closed vocabulary and copy, and the claims that answer it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class UnknownDomain(LookupError):
    """No such domain; there is no default."""


class UnavailableDomain(NotImplementedError):
    """A domain that is known but can't be built yet."""


class Domain(NamedTuple):
    slug: str
    iconic_id: int
    #: Values of the claim, in the order to offer them.
    options: tuple[str, ...]
    copy: dict[str, str]
    ready: bool = True


# The domains' vocabularies and copy.
DOMAINS = {
    "plants": Domain(
        "plants", 47126, ("native", "introduced"),
        {"question": "What plant is this?", "axis1_prompt": "Is it native to this state, or introduced?", "axis1_native": "Native", "axis1_introduced": "Introduced"},
    ),
    "birds": Domain("birds", 3, (), {}, ready=False),
}


def resolve_domain(slug: str) -> Domain:
    """The domain of that name. There is none to fall back on, and one that exists may still wait for its data."""
    found = DOMAINS.get(slug)
    if found is None:
        raise UnknownDomain(f"nothing is called {slug!r} here, choose one of {sorted(DOMAINS)}")
    if not found.ready:
        raise UnavailableDomain(f"{slug} have no data to build from yet")
    return found


def options(spark: SparkSession, domain: Domain) -> DataFrame:
    """place and value of the domain's vocabulary."""
    return spark.createDataFrame([(k, x) for k, x in enumerate(domain.options)], "place int, value string")


def answers(ids: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """ids with the claim of each, null where none was made; a claim is never replaced by a default."""
    known = claims.select(F.col(key).alias("_key"), "claim")
    return ids.join(known, F.col(key) == F.col("_key"), "left").drop("_key")


def retrieved_ref(name: str, url: str, on: Column) -> Column:
    """A reference to a source without editions: its version is the day it was read."""
    day = F.to_date(on)
    return F.struct(F.lit(name).alias("name"), F.concat(F.lit("retrieved "), day.cast("string")).alias("version"), day.cast("timestamp").alias("retrieved_at"), F.lit(url).alias("url"))


def checklist_ref(name: str, url: str, place: Column, at: Column) -> Column:
    """A reference to a place's checklist, as read at a time; the version names the place."""
    version = F.concat(place, F.lit(" checklist retrieved "), F.to_date(at).cast("string"))
    return F.struct(F.lit(name).alias("name"), version.alias("version"), at.alias("retrieved_at"), F.lit(url).alias("url"))


class Profile(NamedTuple):
    """How image bytes are encoded; digests are over the encoded bytes."""

    max_edge: int
    quality: int
    image_format: str
    encoder: str

    def as_version(self) -> str:
        """All that a digest depends on besides the picture, as a source's version."""
        return "/".join(map(str, (self.encoder, self.image_format, self.quality, self.max_edge)))


def produced_by(sources: Column, profile: Profile, bucket: str, at: Column) -> Column:
    """A pool's sources with those of the stage that stored the bytes: the bucket they came from and the encoder."""
    ref = lambda name, version: F.struct(F.lit(name).alias("name"), F.lit(version).alias("version"), at.alias("retrieved_at"), F.lit(bucket).alias("url"))
    return F.concat(sources, F.array(ref("open data", bucket), ref("encoder", profile.as_version())))


def artefact(folder: str, kind: str, state: str) -> str:
    """Where a state's artefact of a stage lies, e.g. work/candidates_MI."""
    return f"{folder}/{kind}_{state.upper()}"
