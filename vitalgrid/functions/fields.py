"""Fields of JSON records, with the numeric rules of the source APIs.

A JSON number and a JSON string may hold the same digits but are read by
different rules (2015.7 is the year 2015, '2015.7' is none). All fields of a
record are taken out as text in one pass; the kind of a value is looked up only
where its text leaves it open.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import clean

# Up to so many fields are looked up one by one in the parsed record; more come out of its text in one pass.
FEW = 12


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns that are computed a single time per row.

    They leave a generator, so a later filter on something derived from them
    is not pushed below and does not compute them again. One generator each
    keeps the generated methods small enough for the JVM to compile.
    """
    for column in columns:
        df = df.select("*", F.inline(F.array(F.struct(column))))
    return df


@dataclass(frozen=True)
class Field:
    """A field of an unpacked record: the spellings to try and their columns."""

    record: str
    spellings: list[str]
    columns: list[str]

    def text(self) -> Column:
        """The value of the first spelling that is there and not JSON null, as text."""
        return F.coalesce(*[F.col(c) for c in self.columns])

    def present(self) -> Column:
        """Zero and '' count as present."""
        return self.text().isNotNull()

    def kind(self) -> Column:
        """The JSON type of that value. Costly; use it behind a cheaper test."""
        out = None
        for spelling, column in zip(self.spellings, self.columns):
            found = F.schema_of_variant(F.try_variant_get(self.record, f"$.{spelling}", "variant"))
            there = F.col(column).isNotNull()
            out = F.when(there, found) if out is None else out.when(there, found)
        return out

    def is_text(self) -> Column:
        return self.kind() == "STRING"

    def string_only(self) -> Column:
        """The text of a JSON string, NULL for any other kind."""
        value = self.text()
        unquoted = value.rlike(r"^[-0-9\[{]|^true$|^false$") & ~self.is_text()
        return F.when(~unquoted, value)

    def number(self) -> Column:
        value = self.text()
        return (
            F.when(value.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), value.try_cast("double"))
            .when(value.isin("true", "false"), F.when(self.kind() == "BOOLEAN", (value == "true").cast("double")))
            .otherwise(clean.double_or_null(value))
        )

    def whole(self) -> Column:
        """JSON numbers lose their fraction; strings must be whole already."""
        value = self.text()
        return F.when(value.rlike(r"^-?[0-9]+$"), value.try_cast("int")).otherwise(
            F.when(self.is_text(), clean.int_or_null(value))
            .when(value == "true", 1).when(value == "false", 0)
            .otherwise(value.try_cast("double").try_cast("int"))
        )

    def truthy(self) -> Column:
        """There, and neither zero, false nor the empty string."""
        value = self.text()
        open_case = value.rlike(r"^-?0(\.0+)?([eE][+-]?[0-9]+)?$|^false$")
        return value.isNotNull() & (value != "") & F.when(open_case, self.is_text()).otherwise(True)


def unpack(df: DataFrame, rec: str, fields: dict[str, list[str]]) -> tuple[DataFrame, dict[str, Field]]:
    """The rows with every spelling of every field as a text column, and the fields.

    Records that are not objects have no fields.
    """
    spellings, made = [], {}
    for name, wanted in fields.items():
        columns = [f"_{name}_{i}" for i in range(len(wanted))]
        made[name] = Field(rec, list(wanted), columns)
        spellings += wanted
    aliases = [c for f in made.values() for c in f.columns]
    if len(spellings) <= FEW:
        return df.select("*", *[F.try_variant_get(rec, f"$.{s}", "string").alias(a) for s, a in zip(spellings, aliases)]), made
    whole = F.try_variant_get(rec, "$", "string")
    return df.select("*", F.json_tuple(whole, *spellings).alias(*aliases)), made

