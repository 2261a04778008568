"""Writers (K9–K11, K14).

Exports write one folder of part files; a single file is produced only when
asked (``single_file=True`` → ``coalesce(1)``, meant for small extracts such
as a TSV for another system).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.functions.dates import parse_iso_timestamp

# Device export columns in file order.
DEVICE_CSV_COLUMNS = ("serialNumber", "deviceId", "macAddress", "annotatedAssetId", "annotatedLocation",
                      "annotatedUser", "notes", "orgUnitPath", "model", "platformVersion", "lastSync", "status")


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    single_file: bool = False, mode: str = "errorifexists") -> None:
    """K9: header, minimal quoting with '"', comma or TAB separator."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", header).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("quoteAll", False).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per line."""
    df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").json(path)


def device_table(devices: DataFrame) -> DataFrame:
    """Device resources → the 12 export columns, lastSync parsed."""
    cols = [F.col(c) for c in DEVICE_CSV_COLUMNS if c != "lastSync"]
    return devices.select(*cols[:10], parse_iso_timestamp("lastSync", missing_as_epoch=False).alias("lastSync"),
                          cols[10])


def audited(df: DataFrame, name: str, rejects: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count rows, and those of them that ``rejects`` holds for, as a side effect of the write that consumes ``df``
    (no second pass).  Read ``obs.get`` after the action."""
    obs = Observation(name)
    refused = F.lit(0).cast("long") if rejects is None else F.count_if(rejects)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), refused.alias("rejects")), obs
