"""Release gates, pointers, upserts, quality checks and closed subsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def first_reason(*cases: tuple[Column, str]) -> Column:
    """The first reason whose test holds, or null."""
    out = None
    for test, reason in cases:
        hit = F.coalesce(test, F.lit(False))
        out = F.when(hit, reason) if out is None else out.when(hit, reason)
    return out


def keep_latest(new: DataFrame, old: DataFrame, keys: Sequence[str], prefer_new: Sequence[str], fill_old: Sequence[str]) -> DataFrame:
    """Upsert: rows of both, new values first; ``fill_old`` columns fall back on the old value where the new is null."""
    n = new.select(*keys, F.struct(*prefer_new, *fill_old).alias("_n"))
    o = old.select(*keys, F.struct(*prefer_new, *fill_old).alias("_o"))
    both = n.join(o, list(keys), "full_outer")
    pick = lambda c: F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c)
    return both.select(*keys, *[pick(c) for c in prefer_new], *[F.coalesce(F.col(f"_n.{c}"), F.col(f"_o.{c}")).alias(c) for c in fill_old])


def insert_absent(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, and new ones whose key is not there yet."""
    return old.unionByName(new.join(old, list(keys), "left_anti").select(*old.columns))


def refused_fields(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns of ``rows`` whose dictionary entry (column_name, access) is not open, or that have none, and how many
    values each would give away. A producer's table is refused when there is any."""
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values")) for c in rows.columns])
    long = counts.select(F.explode(values).alias("v")).select("v.*")
    return long.join(dictionary.where("access = 'open'").select("column_name"), "column_name", "left_anti")


def refresh_dimensions(source: DataFrame, dimensions: dict[str, tuple[DataFrame, list[str], list[str], list[str]]]) -> dict[str, DataFrame]:
    """The canonical dimensions after an active release: each is (old rows, keys, columns that follow the release, columns
    that keep their old value where the release has none), and all are upserts from the one source. Of several values of a
    key each column takes the least, a missing one never; rows that lack a part of the key belong to no dimension."""
    out = {}
    for name, (old, keys, prefer_new, fill_old) in dimensions.items():
        new = source.dropna(subset=keys).groupBy(*keys).agg(*[F.min(c).alias(c) for c in (*prefer_new, *fill_old)])
        out[name] = keep_latest(new, old, keys, prefer_new, fill_old)
    return out


def seen_span(rows: DataFrame, key: str, release: str, published: str) -> DataFrame:
    """First and last release in which an identifier was seen."""
    at = F.struct(published, release)
    return rows.groupBy(key).agg(F.min_by(release, at).alias("first_release"), F.max_by(release, at).alias("last_release"))


def conservation(source: DataFrame, kept: DataFrame, quarantined: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """One row: whether the rows of a source equal what was kept, quarantined and merged."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    out = n(source, "source_rows").crossJoin(n(kept, "kept")).crossJoin(n(quarantined, "quarantined")).crossJoin(n(deduplicated, "deduplicated"))  # four counts
    ok = F.col("source_rows") == F.col("kept") + F.col("quarantined") + F.col("deduplicated")
    return out.withColumn("status", F.when(ok, "passed").otherwise("failed"))


def fingerprint(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A digest of published rows by key, independent of their order: four sums of parts of the rows' hashes. Sums combine
    before the shuffle, so a key may hold any number of rows."""
    line = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rows.columns]), 256)
    sums = [F.sum(F.conv(F.substring("_h", k, 15), 16, 10).cast("decimal(20,0)")).cast("string") for k in (1, 16, 31, 46)]
    return rows.withColumn("_h", line).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *sums).alias("fingerprint"))


def gate(releases: DataFrame, checks: DataFrame, expected_layers: int) -> DataFrame:
    """A release is accepted when its layers are complete, none failed to import, and no blocking check failed."""
    facts = checks.groupBy("release").agg(F.count_distinct("layer").alias("_layers"), F.count_if(F.col("status") == "failed").alias("_failed"), F.count_if(F.col("blocking") & (F.col("status") == "failed")).alias("_blocking"))
    rows = releases.join(facts, "release", "left")
    none = F.coalesce(F.col("_layers"), F.lit(0))
    why = F.array_compact(F.array(F.when(none < expected_layers, "layers_incomplete"), F.when(F.col("_blocking") > 0, "blocking_check_failed")))
    return rows.select("release", none.alias("layers"), F.coalesce("_failed", F.lit(0)).alias("failed_checks"), F.array_join(why, ",").alias("blockers"), (F.size(why) == 0).alias("accepted"))


def closed_subset(keys: DataFrame, key: str, children: DataFrame, foreign: str, optional: dict[str, DataFrame] | None = None) -> DataFrame:
    """Children whose required key is kept; optional keys outside the subset become null."""
    out = children.join(keys.select(F.col(key).alias(foreign)).distinct(), foreign, "left_semi")
    for column, kept in (optional or {}).items():
        k = kept.select(F.col(kept.columns[0]).alias("_kept")).distinct()
        out = out.join(k, out[column] == F.col("_kept"), "left").withColumn(column, F.col("_kept")).drop("_kept")
    return out


def time_violations(snapshots: DataFrame, releases: DataFrame) -> DataFrame:
    """Uses of a release that is unknown or published after the snapshot. Snapshots: snapshot, snapshot_at, release_ids."""
    used = snapshots.select("snapshot", "snapshot_at", F.explode("release_ids").alias("release"))
    rows = used.join(releases.select("release", "published_at"), "release", "left")
    why = first_reason((F.col("published_at").isNull(), "unknown_release"), (F.col("published_at") > F.col("snapshot_at"), "later_release"))
    return rows.withColumn("violation", why).where("violation is not null").select("snapshot", "release", "violation")


def coverage(areas: DataFrame, rows: DataFrame, area: str, source: str, wanted: list[str], least: int = 1, release: str | None = None) -> DataFrame:
    """Of each area: how many of the wanted sources it has (members), which it lacks, which have fewer than ``least`` rows,
    the number of distinct latest releases among them, and covered / partial / not_covered. An area without any row lacks
    all; a null area is none; sources that are not wanted do not count. ``wanted`` is a short list."""
    latest = F.max(release if release else F.lit(None).cast("string"))
    cells = rows.where(F.col(source).isin(wanted)).groupBy(area, source).agg(F.count(F.lit(1)).alias("_n"), latest.alias("_r"))
    held = cells.groupBy(area).agg(F.collect_set(source).alias("_any"), F.collect_set(F.when(F.col("_n") >= least, F.col(source))).alias("_enough"), F.count_distinct("_r").alias("releases"))
    out = areas.select(area).where(F.col(area).isNotNull()).distinct().join(held, area, "left")
    listed, none = F.array(*[F.lit(w) for w in sorted(wanted)]), F.array().cast("array<string>")
    out = out.withColumns({"missing": F.array_except(listed, F.coalesce("_any", none)), "weak": F.array_except(listed, F.coalesce("_enough", none))})
    state = F.when(F.size("missing") == 0, "covered").when(F.size("missing") < len(wanted), "partial").otherwise("not_covered")
    return out.select(area, (F.lit(len(wanted)) - F.size("missing")).alias("members"), "missing", "weak", F.coalesce("releases", F.lit(0)).alias("releases"), state.alias("coverage"))


def attested(measures: DataFrame, attestations: DataFrame) -> DataFrame:
    """Measures (with a fingerprint) and the last attestation (number) written for exactly these; none of them counts once
    a measure has changed. An attestation without fingerprint or number stops the job: the mention must not hang on a slip."""
    if not attestations.where("fingerprint is null or number is null").isEmpty():
        raise ValueError("an attestation lacks its fingerprint or number")
    last = attestations.groupBy("fingerprint").agg(F.max("number").alias("number"))
    return measures.join(last, "fingerprint", "left").withColumn("recounted", F.col("number").isNotNull())


def evidence_violations(evidence: DataFrame, snapshots: DataFrame, key: str) -> DataFrame:
    """Evidence that its snapshot must not carry, with the first reason: no such snapshot, observed after it, or taken from a
    release outside its set. Evidence: key, snapshot, observed_at (null: undated, no fault), release_ids (null: none).
    Snapshots: snapshot (once each), snapshot_at, release_ids."""
    known = snapshots.select("snapshot", "snapshot_at", F.col("release_ids").alias("_set"))
    rows = evidence.select(key, "snapshot", "observed_at", "release_ids").join(known, "snapshot", "left")
    outside = F.size(F.array_except("release_ids", F.coalesce("_set", F.array_distinct(F.slice("release_ids", 1, 0))))) > 0
    why = first_reason(
        (F.col("snapshot_at").isNull(), "unknown_snapshot"), (F.col("observed_at") > F.col("snapshot_at"), "newer_than_snapshot"),
        (F.col("release_ids").isNotNull() & outside, "release_outside_snapshot"),
    )
    return rows.withColumn("violation", why).where("violation is not null").select(key, "snapshot", "violation")
