"""Fixed dimensions as Spark values: search groups, fields, output model,
source priorities, blacklist. All are literal and tiny (bounded by the
catalogue, not by data), so they are used as array literals or broadcast."""

from __future__ import annotations

from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from vendorscope import fixed

DEFAULT_CATEGORY = "WEDDING_PLANNERS"


def groups_for(category: str = DEFAULT_CATEGORY) -> list[tuple[str, str, list[str]]]:
    return fixed.SEARCH_MODELS[category]


def sources_for(group_name: str) -> list[str]:
    return fixed.SOURCE_PRIORITIES.get(group_name, fixed.SOURCE_PRIORITIES["*"])


def sources_text(group_name: str) -> str:
    """Numbered source list, one per line, highest priority first."""
    return "\n".join(f"{i}. {s}" for i, s in enumerate(sources_for(group_name), start=1))


def group_array(category: str = DEFAULT_CATEGORY) -> Column:
    """The category's search groups as an array literal of structs (catalogue order)."""
    return F.array(*[
        F.struct(F.lit(name).alias("group_name"), F.lit(desc).alias("description"),
                 F.array(*[F.lit(f) for f in fields]).alias("fields"),
                 F.lit(sources_text(name)).alias("sources"),
                 F.array(*[F.lit(x) for x in sources_for(name)]).alias("source_list"))
        for name, desc, fields in groups_for(category)])


def output_fields(category: str = DEFAULT_CATEGORY) -> list[tuple[str, str]]:
    return fixed.OUTPUT_MODELS[category]


def output_schema(category: str = DEFAULT_CATEGORY) -> Ty.StructType:
    """SRC-5: the output model as a StructType (string fields, array<string> fields)."""
    return Ty.StructType([
        Ty.StructField(f, Ty.StringType() if k == "string" else Ty.ArrayType(Ty.StringType()))
        for f, k in output_fields(category)])


def output_model_text(category: str = DEFAULT_CATEGORY) -> str:
    """The output model as the JSON skeleton text placed in the prompt."""
    return model_text(output_fields(category))


def model_text(fields: list[tuple[str, str]]) -> str:
    """A JSON skeleton of (field, kind) pairs."""
    body = ",\n".join(f'  "{f}":""' if k == "string" else f'  "{f}":[]' for f, k in fields)
    return "\n{\n" + body + "\n}"


GROUP_TYPE = "struct<group_name:string,description:string,fields:array<string>,sources:string,source_list:array<string>>"
MOST_CATEGORIES = 10_000  # a catalogue goes to every executor, so its size is checked


def catalogue(spark: SparkSession, models: dict = fixed.SEARCH_MODELS, outputs: dict = fixed.OUTPUT_MODELS) -> DataFrame:
    """The catalogue as a table: category, groups (in order), model (the output skeleton's text, null without one).

    ``models``: category -> [(group, description, fields)]; ``outputs``: category -> [(field, kind)].
    """
    if len(models) > MOST_CATEGORIES:
        raise ValueError(f"a catalogue has at most {MOST_CATEGORIES} categories")
    rows = [(c, [(g, about, list(fields), sources_text(g), sources_for(g)) for g, about, fields in groups],
             model_text(outputs[c]) if c in outputs else None) for c, groups in models.items()]
    return spark.createDataFrame(rows, f"category string, groups array<{GROUP_TYPE}>, model string")


def blacklist() -> Column:
    return F.array(*[F.lit(s) for s in fixed.INVALID_SOURCES])


def question_pieces() -> list[str | tuple[str]]:
    """The question template split once into literal text and slot names."""
    import re
    out: list = []
    pos = 0
    tmpl = dedent(fixed.QUESTION_TEMPLATE)
    for m in re.finditer(r"\{(\w+)\}", tmpl):
        out.append(tmpl[pos:m.start()])
        out.append((m.group(1),))
        pos = m.end()
    out.append(tmpl[pos:])
    return out
