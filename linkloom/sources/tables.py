"""Reading and writing: tables, small reports, JSON, paths and arguments."""

from __future__ import annotations

import argparse
import json
import logging
import os
import time
import zipfile
from dataclasses import dataclass
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns whose values are not to be shown.
PROTECTED = r"^(id_|name|phone)"


@dataclass(frozen=True)
class Paths:
    """Where the stages keep their tables, below one folder."""

    root: str

    def __getattr__(self, name: str) -> str:
        known = {"d1_raw", "d2_raw", "d1", "d2", "records", "reference", "predictions", "scores", "links", "fit"}
        if name not in known:
            raise AttributeError(name)
        return f"{self.root}/{name}.parquet"


def session(name: str = "linkloom", threads: int = 8, memory: str = "10g", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name).master(f"local[{threads}]").config("spark.driver.memory", memory).config("spark.sql.session.timeZone", "UTC")
    for k, v in conf.items():
        b = b.config(k.replace("_", "."), v)
    return b.getOrCreate()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Writes a table and reads it again; list columns become Parquet lists."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for reports of a bounded number of rows."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def save_xlsx(df: DataFrame, path: str, most: int = 100_000) -> None:
    """One sheet of a report of at most so many rows, as an XLSX file; more rows are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write a table instead")

    def cell(x: object) -> str:
        if x is None:
            return "<c/>"
        if isinstance(x, (int, float)) and not isinstance(x, bool):
            return f"<c><v>{x}</v></c>"
        text = "; ".join(map(str, x)) if isinstance(x, (list, tuple)) else str(x)
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape("".join(c for c in text if c >= " " or c in chr(9) + chr(10)))}</t></is></c>'

    lines = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [tuple(df.columns), *map(tuple, rows)])
    main, office, package = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    files = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/sheet.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="report" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="sheet.xml"/></Relationships>',
        "xl/sheet.xml": f'<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + body)


def save_json(obj: object, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=1)


def run_info(path: str, **what: object) -> None:
    save_json(what | {"written": time.strftime("%Y-%m-%d %H:%M:%S")}, path)


def describe(df: DataFrame) -> DataFrame:
    """column, type, rows."""
    n = df.count()
    return df.sparkSession.createDataFrame([(c, t, n) for c, t in df.dtypes], "column string, type string, rows long")


def arguments(argv: list[str] | None = None, **defaults: object) -> argparse.Namespace:
    """--name=value for each default, of the default's type."""
    parser = argparse.ArgumentParser()
    for k, v in defaults.items():
        kind = (lambda x: x.lower() in ("1", "true", "yes")) if isinstance(v, bool) else type(v)
        parser.add_argument("--" + k.replace("_", "-"), type=kind, default=v)
    return parser.parse_args(argv)


def log_to(path: str) -> logging.Logger:
    logger = logging.getLogger("linkloom")
    logger.addHandler(logging.FileHandler(path))
    logger.setLevel(logging.INFO)
    return logger


def drop_protected(df: DataFrame, pattern: str = PROTECTED) -> DataFrame:
    import re

    return df.select([c for c in df.columns if not re.search(pattern, c)])


def peek(df: DataFrame, n: int = 6) -> DataFrame:
    return drop_protected(df).limit(n)


def kept_dir(spark: SparkSession) -> str:
    """The folder for checkpoints, which driver and executors share."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/linkloom")
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, kept in the folder that driver and executors share."""
    kept_dir(df.sparkSession)
    return df.checkpoint()


def harmonized(raw: DataFrame, suffix: str, joined: dict[str, str] | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Raw columns name_<suffix>... as row, name, date, age, sex, adm1 to adm4, phone_raw, job_raw.

    joined: for a place column, the one to prefer where it is filled. extra: further columns to keep.
    """
    from linkloom.functions.text import first_filled

    joined = joined or {}
    own = lambda c: F.col(f"{c}_{suffix}") if f"{c}_{suffix}" in raw.columns else F.lit(None).cast("string")
    place = [first_filled(*([F.col(joined[c])] if c in joined else []), own(c)).alias(c) for c in ("adm1", "adm2", "adm3", "adm4")]
    return raw.select(own("row").alias("row"), *[own(c).alias(c) for c in ("name", "date", "age", "sex")], *place, own("phone").alias("phone_raw"), own("job").alias("job_raw"), *extra)
