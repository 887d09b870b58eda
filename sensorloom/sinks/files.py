"""CSV and JSON exports."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names


BOM = "\ufeff"


def with_bom(df: DataFrame) -> DataFrame:
    """The first column named with a byte order mark in front: every CSV file of the result then begins with it."""
    return df.toDF(BOM + df.columns[0], *df.columns[1:]) if df.columns else df


def save_results(results: Mapping[str, DataFrame], folder: str, mode: str = "overwrite", bom: bool = True) -> None:
    """One CSV folder per result table, in UTF-8 with a byte order mark, by which spreadsheets know the encoding."""
    for feature, df in results.items():
        (with_bom(df) if bom else df).write.mode(mode).option("header", "true").csv(f"{folder}/{feature}")


def feature_export_name(metrics: Sequence[str] | str | None, freq: str | None) -> str:
    """Folder name made of the metrics and the frequency."""
    text = metrics if isinstance(metrics, str) else "_".join(str(m) for m in metrics or [])
    return re.sub(r"[^\w\-.]", "_", text or "all") + "_" + (freq or "full")


def save_per_device(
    df: DataFrame, folder: str, metrics: Sequence[str] | None = None, freq: str | None = None,
    device: str = "device_id", mode: str = "overwrite",
) -> str:
    """CSV folders per device below a folder named after metrics and frequency."""
    path = f"{folder}/{feature_export_name(metrics, freq)}"
    (
        df.hint("rebalance", device).sortWithinPartitions(device)
        .write.mode(mode).option("header", "true").partitionBy(device).csv(path)
    )
    return path


def merged_export_name(start: str, end: str, temple_id: str | None = None, device_id: str | None = None) -> str:
    parts = [p for p in (temple_id, device_id, start, end) if p]
    return "_".join(re.sub(r"\D", "", p[:10]) if p in (start, end) else p for p in parts)


def save_merged(df: DataFrame, folder: str, start: str, end: str, temple_id=None, device_id=None, mode="overwrite") -> str:
    path = f"{folder}/{merged_export_name(start, end, temple_id, device_id)}"
    df.write.mode(mode).option("header", "true").csv(path)
    return path


_WHOLE = ("int", "bigint", "smallint", "tinyint", "boolean")


def _json_text(name: str, kind: str) -> Column:
    """One value as JSON text: ISO times, NaN as null, infinities spelled."""
    c = names.col(name)
    if kind in ("double", "float"):
        spelled = F.when(c > 0, '"Infinity"').otherwise('"-Infinity"')
        infinite = c.isin(float("inf"), float("-inf"))
        text = F.when(F.isnan(c), "null").when(infinite, spelled).otherwise(c.cast("string"))
    elif kind in _WHOLE:
        text = c.cast("string")
    else:
        if kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")
        elif kind == "timestamp_ntz":
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        # Spark escapes the text; the array brackets around it are cut off
        listed = F.to_json(F.array(c.cast("string")))
        text = F.when(c.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))
    return F.coalesce(text, F.lit("null"))


def json_object(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row as JSON object in which missing values are explicit nulls."""
    kinds = dict(df.dtypes)
    parts = [
        F.concat(F.lit(json.dumps(c, ensure_ascii=False) + ": "), _json_text(c, kinds[c]))
        for c in columns or df.columns
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def to_json_rows(df: DataFrame, out: str = "feature") -> DataFrame:
    """One JSON object per row; the form to use for results of any size."""
    return df.select(json_object(df).alias(out))


def to_feature_documents(
    df: DataFrame, ids: Sequence[str] = (), time: str = "time", out: str = "features_json"
) -> DataFrame:
    """``{"features": [...]}`` in time order, one document per id set.

    Meant for the answer to one request: a document holds one entry per
    bucket, which the calendar bounds.
    """
    body = json_object(df, [c for c in df.columns if c not in ids])
    rows = df.select(*ids, F.struct(F.col(time).alias("t"), body.alias("j")).alias("_row"))
    ordered = F.transform(F.array_sort(F.collect_list("_row")), lambda r: r["j"])
    return rows.groupBy(*ids).agg(
        F.concat(F.lit('{"features": ['), F.array_join(ordered, ", "), F.lit("]}")).alias(out)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object per row."""
    to_json_rows(df).write.mode(mode).text(path)
