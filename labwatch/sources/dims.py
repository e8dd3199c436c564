"""Small lookup tables held in code; larger ones are read from the user's files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import epi_calendar  # noqa: F401
from labwatch.functions.text import place_key


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few constant rows as a plan literal, whose size Spark knows."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def age_groups(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, vocab.AGE_BANDS, ["age_group", "min_age", "max_age"])


def test_methods(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, list(vocab.KIT_METHODS.items()), ["test_kit", "test_method"])


def municipality_keys(df: DataFrame, name: str = "NM_MUN", state: str = "NM_UF") -> DataFrame:
    """Name keys the place join matches on."""
    return df.withColumns({"NM_MUN_NORM": place_key(name), "NM_UF_NORM": place_key(state)})


def state_columns(code: Column) -> dict[str, Column]:
    """Name, region and numeric code of a state abbreviation."""
    table = F.create_map(
        *[
            x
            for key, (name, region, number) in vocab.STATES.items()
            for x in (F.lit(key), F.struct(F.lit(name).alias("n"), F.lit(region).alias("r"), F.lit(number).alias("c")))
        ]
    )
    entry = F.try_element_at(table, code)
    return {"NM_UF": entry["n"], "REGIAO": entry["r"], "CD_UF": entry["c"]}
