"""GeoJSON features, one value after the other, in one file or a tree of folders.

Most files have a feature on each line; such lines are parsed where they are. What isn't a feature by itself (values over
several lines, several on one line, broken lines) is put together again file by file, in order: values are told apart
by their braces, and only the broken ones are lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.functions.text import empty_to_null
from postmill.operators.ingest import skipping
from postmill.schema import FIELDS, TEXT_FIELDS


def parsed(lines: DataFrame, column: str = "value", seen: Observation | None = None) -> DataFrame:
    """Addresses of lines of JSON; a line stays only if its types are strictly right.

    All seven properties must be texts and the coordinates two numbers, longitude first. Empty
    texts become null.
    """
    v = F.try_parse_json(column)
    kind = lambda path: F.schema_of_variant(F.variant_get("v", path, "variant"))
    position = ["_position"] if "_position" in lines.columns else []
    # A generator makes sure that each line is parsed once, not once for each field.
    read = lines.select(F.explode(F.array(v)).alias("v"), *position)
    texts = [kind(f"$.properties.{f}") == "STRING" for f in TEXT_FIELDS]
    numeric = lambda path: kind(path).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    good = numeric("$.geometry.coordinates[0]") & numeric("$.geometry.coordinates[1]") & F.variant_get("v", "$.geometry.coordinates[2]", "variant").isNull()
    for t in texts:
        good = good & t
    value = lambda path, t: F.try_variant_get("v", path, t)
    return skipping(read, F.coalesce(F.col("v").isNotNull() & good, F.lit(False)), seen).select(
        value("$.geometry.coordinates[1]", "double").alias("lat"), value("$.geometry.coordinates[0]", "double").alias("lon"),
        *(empty_to_null(value(f"$.properties.{f}", "string")).alias(f) for f in TEXT_FIELDS), *position,
    ).select(*FIELDS, *position)


def values_of(texts: Iterator[str]) -> Iterator[str]:
    """The JSON objects of lines in order, each as one text; what stands between them is left out."""
    held, depth, quoted, escaped = [], 0, False, False
    for line in texts:
        start = 0
        for place, c in enumerate(line):
            if quoted:
                escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
            elif c == '"':
                quoted = depth > 0
            elif c == "{":
                if not depth:
                    start = place
                depth += 1
            elif c == "}" and depth:
                depth -= 1
                if not depth:
                    yield "".join([*held, line[start : place + 1]])
                    held, start = [], place + 1
        if depth:
            held.append(line[start:] + " ")
            quoted = escaped = False  # no text goes over the end of a line


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of the rows (file, value, position), which come sorted by file and position."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), batch.column("start").to_pylist(), batch.column("row").to_pylist(), strict=True)

    def out(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["file", "value", "start", "row"])

    found: list[tuple] = []
    for file, own in groupby(rows(), key=lambda r: r[0]):
        at: list[tuple] = []

        def lines(own=own, at=at) -> Iterator[str]:
            for _, value, start, row in own:
                at[:] = [(start, row)]
                yield value

        for value in values_of(lines()):
            found.append((file, value, *at[0]))
            if len(found) >= 1000:
                yield out(found)
                found = []
    if found:
        yield out(found)


def read_openaddresses(spark: SparkSession, path: str | list[str], seen: Observation | None = None) -> DataFrame:
    """Addresses of all *.geojson files below the folders; a file may be named itself. `seen` counts values read and skipped."""
    names = [path] if isinstance(path, str) else list(path)
    lines = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.geojson").text(names).where(F.trim("value") != "")
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    v = F.try_parse_json("value")
    # The parser stops after the first value of a line, so lines that may have more are looked through.
    whole = F.coalesce(F.variant_get(v, "$.properties", "variant").isNotNull(), F.lit(False)) & ~F.col("value").rlike(r"\}\s*\{")
    position = F.struct(F.col("file").alias("file_path"), F.col("start").alias("file_block_start"), "row").alias("_position")
    rest = lines.where(~whole).repartition("file").sortWithinPartitions("file", "start", "row").mapInArrow(_joined, "file string, value string, start long, row long")
    return parsed(lines.where(whole).select("value", position).unionByName(rest.select("value", position)), seen=seen)
