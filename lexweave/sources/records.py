"""Structured records: JSON parsing with strict types, rule violations, fail-fast checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import is_blank
from ..session import materialize


class RecordError(ValueError):
    pass


# --- reading ---------------------------------------------------------------------


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line, in ``value``; files split freely."""
    return spark.read.text(path).filter(F.length("value") > 0)


def read_ordered_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, position, ord, value``: JSON lines numbered from 0 in file and in all files.

    ``position`` counts the non-empty lines of a file, ``ord`` those of all files in the order
    of their paths, both whatever splits the files were read in. Lines are stored once with
    their split and place in it; one row a split is added up and sent to all tasks, so that
    part grows with the list of splits the driver plans anyway. A null line cannot occur;
    folders without lines give no rows, repeated lines get numbers of their own.
    """
    lines = read_json_lines(spark, path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("__start"),
        "value",
    )
    stored = materialize(lines.withColumn("__at", F.monotonically_increasing_id()), "json-lines")
    splits = stored.groupBy("path", "__start").agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )
    before = Window.orderBy("path", "__start").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("path").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "path", "__start", "__first",
        F.coalesce(F.sum("__n").over(own), F.lit(0)).alias("__in_file"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__in_all"),
    )
    place = F.col("__at") - F.col("__first")
    return stored.join(F.broadcast(starts), ["path", "__start"]).select(
        "path", (F.col("__in_file") + place).alias("position"),
        (F.col("__in_all") + place).alias("ord"), "value",
    )


def read_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Items of the JSON arrays in each file, with their position in the file.

    A JSON array has to be parsed as a whole, so the unit of parallelism is the file;
    corpora beyond a file's worth belong in JSON lines.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.try_parse_json("value").alias("doc")
    )
    items = F.expr("try_variant_get(doc, '$', 'array<variant>')")
    return files.select(
        "path",
        F.posexplode(
            F.when(F.size(items) > 0, items).otherwise(
                F.raise_error(F.lit("data must be a non-empty JSON list"))
            )
        ).alias("position", "item"),
    )


def _typed(item: Column, field: str) -> tuple[Column, Column]:
    value = F.try_variant_get(item, f"$.{field}", "variant")
    return value, F.schema_of_variant(value)


def _string(item: Column, field: str) -> Column:
    """A field only where it is a JSON string; numbers and arrays are not converted."""
    _, kind = _typed(item, field)
    return F.when(kind == "STRING", F.try_variant_get(item, f"$.{field}", "string"))


def parse_instruction_records(rows: DataFrame, item: Column, *keys: str) -> DataFrame:
    """``instruction``, ``input``, ``output``; null where missing or not a string."""
    parsed = rows.select(*keys, item.alias("__item"))
    fields = [_string(F.col("__item"), f).alias(f) for f in ("instruction", "input", "output")]
    return parsed.select(*keys, *fields)


def parse_choice_records(rows: DataFrame, item: Column, *keys: str) -> DataFrame:
    """``question``, ``subject``, ``choices``, ``answer``; null where the type is wrong.

    Booleans are not answers and non-string choices void the list.
    """
    parsed = rows.select(*keys, item.alias("__item"))
    it = F.col("__item")
    _, answer_kind = _typed(it, "answer")
    _, choices_kind = _typed(it, "choices")
    return parsed.select(
        *keys,
        _string(it, "question").alias("question"),
        _string(it, "subject").alias("subject"),
        F.when(
            choices_kind == "ARRAY<STRING>",
            F.try_variant_get(it, "$.choices", "array<string>"),
        ).alias("choices"),
        F.when(answer_kind == "BIGINT", F.try_variant_get(it, "$.answer", "int")).alias("answer"),
    )


def parse_prompts(rows: DataFrame, item: Column, order: str, mode: str) -> DataFrame:
    """Prompt list items: bare strings (completion mode) or objects with an optional id.

    ``error`` names what is wrong with an item and is null otherwise.
    """
    if mode not in {"completion", "instruction"}:
        raise ValueError("mode must be 'completion' or 'instruction'")
    required = "prompt" if mode == "completion" else "instruction"
    it = F.col("__item")
    bare = F.try_variant_get(it, "$", "string")
    is_bare = (F.schema_of_variant(it) == "STRING") & (F.length(bare) > 0)
    is_bare = is_bare if mode == "completion" else F.lit(False)
    is_object = F.schema_of_variant(it).startswith("OBJECT")
    id_value, id_kind = _typed(it, "id")
    input_value, input_kind = _typed(it, "input")
    default_id = F.concat(F.lit("prompt-"), (F.col(order) + 1).cast("string"))
    given_id = F.when(id_value.isNull(), default_id).otherwise(_string(it, "id"))
    content = _string(it, required)
    bad_input = (
        input_value.isNotNull() & (input_kind != "STRING") if mode == "instruction" else F.lit(False)
    )
    error = (
        F.when(is_bare, F.lit(None))
        .when(~is_object, F.lit("must be a JSON object"))
        .when(F.coalesce(F.length(given_id), F.lit(0)) == 0, F.lit("has an invalid id"))
        .when(
            F.coalesce(is_blank(content), F.lit(True)),
            F.lit(f"requires non-empty string '{required}'"),
        )
        .when(bad_input, F.lit("input must be a string"))
    )
    return rows.select(order, item.alias("__item")).select(
        order,
        F.when(is_bare, default_id).otherwise(given_id).alias("id"),
        F.when(is_bare, bare).otherwise(content).alias(required),
        (F.lit("") if mode == "completion" else F.coalesce(_string(it, "input"), F.lit(""))).alias(
            "input"
        ),
        error.alias("error"),
    )


def require_prompts(parsed: DataFrame, order: str) -> DataFrame:
    """Parsed prompts without ``error``; fails on an empty list or on the first bad item."""
    if parsed.isEmpty():
        raise RecordError("prompt list is empty")
    bad = parsed.filter(F.col("error").isNotNull())
    first = bad.orderBy(order).select(F.col(order).alias("at"), "error").limit(1).collect()
    if first:
        raise RecordError(f"prompt item {first[0]['at']} {first[0]['error']}")
    return parsed.drop("error")


# --- validation ------------------------------------------------------------------


def text_rules(text: str = "text") -> list[tuple[str, Column]]:
    return [("text_missing", F.col(text).isNull())]


def instruction_rules(require_instruction: bool = True) -> list[tuple[str, Column]]:
    """A rule holds where a record is wrong."""
    rules = [(f"{f}_not_string", F.col(f).isNull()) for f in ("instruction", "input", "output")]
    if require_instruction:
        rules.append(("instruction_blank", is_blank(F.col("instruction"))))
    return rules


def choice_rules() -> list[tuple[str, Column]]:
    def blank(column):
        return F.coalesce(is_blank(column), F.lit(True))

    return [
        ("question_blank", blank(F.col("question"))),
        ("subject_blank", blank(F.col("subject"))),
        (
            "choices_not_four",
            F.coalesce(
                (F.size("choices") != 4) | F.exists("choices", blank), F.lit(True)
            ),
        ),
        ("answer_out_of_range", ~F.coalesce(F.col("answer").between(0, 3), F.lit(False))),
    ]


def broken_rules(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules a record breaks, in their order; empty for a good record."""
    return F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(n)) for n, bad in rules])
    )


def violations(df: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per broken rule: ``key, rule, message``."""
    broken = df.select(key, F.explode(broken_rules(rules)).alias("rule"))
    return broken.withColumn(
        "message",
        F.concat(
            F.lit("record "), F.col(key).cast("string"), F.lit(": "),
            F.replace(F.col("rule"), F.lit("_"), F.lit(" ")),
        ),
    )


def valid_rows(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    good = F.lit(True)
    for _, bad in rules:
        good = good & ~F.coalesce(bad, F.lit(False))
    return df.filter(good)


def require_valid(df: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Fail on an empty table or on the first violation in record order."""
    if df.isEmpty():
        raise RecordError("input records are empty")
    first = violations(df, key, rules).orderBy(key).limit(1).collect()
    if first:
        raise RecordError(first[0]["message"])
    return df
