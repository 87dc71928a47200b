"""Age-specific fertility: choice of sex and variants, then bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import ages, clean, fields
from vitalgrid.operators import pick
from vitalgrid.refdata import (
    FERTILITY_SEXES,
    FERTILITY_VARIANTS,
    SEX_NAMES,
    VALUE_NAMES,
    VARIANT_NAMES,
)

SLICE = ["iso3", "year"]


def groupable(records: DataFrame) -> DataFrame:
    """Typed records; those without a whole sex id or a variant name drop out.

    Bins and values stay NULL where unreadable: the choice of sex and variant
    looks at these rows too.
    """
    wanted = {"sex": SEX_NAMES, "variant": VARIANT_NAMES, "value": VALUE_NAMES, **ages.BIN_FIELDS}
    texts, f = fields.unpack(records, "rec", wanted)
    typed = fields.once(
        texts,
        f["sex"].whole().alias("sex"),
        clean.code(f["variant"].string_only()).alias("variant"),
        f["value"].number().alias("asfr"),
        f["start"].whole().alias("start"),
        f["end"].whole().alias("end"),
    )
    rows = typed.where(F.col("sex").isNotNull() & (F.col("variant") != ""))
    return fields.once(rows, ages.record_bin(f).alias("bin")).select(
        *SLICE, "_page", "_pos", "sex", "variant", "bin", "asfr"
    )


def chosen_variants(rows: DataFrame, buckets: dict[str, list[str]] = FERTILITY_VARIANTS) -> DataFrame:
    """(slice, sex, bucket, variant) that ``bins`` uses, of rows as from ``groupable``."""
    per_sex = pick.first_candidates(rows, [*SLICE, "sex"], "variant", buckets)
    per_slice = pick.preferred(per_sex, SLICE, "sex", FERTILITY_SEXES)
    return pick.bucket_rows(per_slice, [*SLICE, "sex"], buckets)


def bins(records: DataFrame, buckets: dict[str, list[str]] = FERTILITY_VARIANTS) -> DataFrame:
    """One row per slice, bucket and age bin inside the fertile window.

    Female rows are preferred, then both sexes; the sex is settled by presence
    alone. Every bucket must have a variant for that sex, or the slice is out. Of
    rows for the same bin the last delivered counts.

    One pass reduces the records to the last value of each (slice, sex, variant,
    bin), a variant that no bucket asks for and a bin that cannot be used as none;
    what is left of a slice then is no more than there are bins, and sex and
    variants are chosen on it.
    """
    asked = [v for candidates in buckets.values() for v in candidates]
    rows = groupable(records).where(F.col("sex").isin(FERTILITY_SEXES))
    variant = F.when(F.col("variant").isin(asked), F.col("variant"))
    usable = variant.isNotNull() & F.col("asfr").isNotNull() & ages.fertile(F.col("bin.age_min"), F.col("bin.age_max"))
    state = (
        rows.select(
            *SLICE, "sex", variant.alias("variant"), F.struct("_page", "_pos").alias("_at"),
            *[F.when(usable, F.col(c)).alias(c.split(".")[-1]) for c in ("bin.age_min", "bin.age_max", "asfr")],
        )
        .groupBy(*SLICE, "sex", "variant", "age_min", "age_max")
        .agg(F.max_by("asfr", "_at").alias("asfr"))
    )

    def best(sex: int) -> Column:
        """The variant of each bucket for the sex, NULL where it has none."""
        ranks = [F.min(F.when(F.col("sex") == sex, pick.rank_in(F.col("variant"), names))) for names in buckets.values()]
        return F.array(*[F.get(F.array(*[F.lit(n) for n in names]), rank) for names, rank in zip(buckets.values(), ranks)])

    chosen, sex = F.lit(None), F.lit(None).cast("int")
    for s in reversed(FERTILITY_SEXES):
        there = F.max((F.col("sex") == s).cast("int")) == 1
        chosen, sex = F.when(there, best(s)).otherwise(chosen), F.when(there, F.lit(s)).otherwise(sex)
    cells = F.collect_list(F.when(F.col("age_min").isNotNull(), F.struct("sex", "variant", "age_min", "age_max", "asfr")))
    slices = state.groupBy(*SLICE).agg(chosen.alias("_chosen"), sex.alias("_sex"), cells.alias("_cells"))
    names = F.array(*[F.lit(n) for n in buckets])
    wanted = F.filter("_cells", lambda c: (c["sex"] == F.col("_sex")) & F.array_contains("_chosen", c["variant"]))
    rows = F.transform(
        wanted,
        lambda c: F.struct(
            F.get(names, (F.array_position("_chosen", c["variant"]) - 1).cast("int")).alias("variant_short_name"),
            c["age_min"].alias("age_min"), c["age_max"].alias("age_max"), c["asfr"].alias("asfr"),
        ),
    )
    return slices.where(F.forall("_chosen", lambda v: v.isNotNull())).select(*SLICE, F.inline(rows))


def bin_summary(rows: DataFrame) -> DataFrame:
    """Distinct fertile bins per (slice, sex, variant): how many, the first and last ten.

    ``rows`` as from ``groupable``. Bins lie inside a fixed age window, so the
    distinct set of a group is bounded.
    """
    inside = rows.where(ages.fertile(F.col("bin.age_min"), F.col("bin.age_max")))
    label = F.format_string("%02d-%02d", F.col("bin.age_min"), F.col("bin.age_max"))
    seen = (
        rows.select(*SLICE, "sex", "variant").distinct()
        .join(
            inside.groupBy(*SLICE, "sex", "variant").agg(F.array_sort(F.collect_set(label)).alias("bins")),
            [*SLICE, "sex", "variant"],
            "left",
        )
        .withColumn("bins", F.coalesce("bins", F.array().cast("array<string>")))
    )
    n = F.size("bins")
    return seen.select(
        *SLICE, "sex", "variant", n.alias("n_bins"),
        F.array_join(F.slice("bins", 1, 10), ",").alias("head"),
        F.when(n > 10, F.array_join(F.slice("bins", -10, 10), ",")).otherwise("").alias("tail"),
    )
