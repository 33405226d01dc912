"""Sources: CSV, JSON documents and directories, JSONL, workbook columns, key-value markdown, index tables, query tokens."""

from __future__ import annotations

import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.blanks import existing
from ..functions.text import registry_name, words
from .json_list import read_json_list
from .numbered import read_numbered_json


def text_schema(columns: list[str]) -> T.StructType:
    """All columns as text: nothing is inferred, so '843.0' and '00123' stay what they are."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_records(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with quoted line feeds and doubled quotes; blanks are ''. Without columns the header names them."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("enforceSchema", False)
    df = reader.schema(text_schema(columns)).csv(path) if columns else reader.csv(path)
    return df.na.fill("")


def ensure_columns(df: DataFrame, names: list[str], value: str = "") -> DataFrame:
    missing = {n: F.lit(value) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def normalize_artifacts(df: DataFrame) -> DataFrame:
    """'158515.0' as '158515' in every text column."""
    return df.withColumns({c: F.regexp_replace(c, r"^(-?[0-9]+)\.0$", "$1") for c, t in df.dtypes if t == "string"})


_PAGE = "struct<markdown:string,url:string,metadata:struct<sourceURL:string,url:string>>"


def read_page_export(spark: SparkSession, path: str) -> DataFrame:
    """url, markdown from JSON lists or {"data": [...]} of any size: the longest text of a URL, the first of equals, in order of file name and place."""
    pages = read_json_list(spark, path).select("file", "pos", F.from_json("text", _PAGE).alias("p"))
    url = F.coalesce(*(F.nullif(existing(c), F.lit("")) for c in (F.col("p.metadata.sourceURL"), F.col("p.metadata.url"), F.col("p.url"))))
    text = F.coalesce("p.markdown", F.lit(""))
    best = F.min(F.struct((-F.length(text)).alias("minus"), "file", "pos", text.alias("markdown"))).alias("m")
    return pages.select(url.alias("url"), "file", "pos", "p").where("url is not null").groupBy("url").agg(best).select("url", "m.markdown")


def read_json_directory(spark: SparkSession, path: str, schema: str, key: str = "record_id") -> DataFrame:
    """One JSON object by file; broken files and blank keys are skipped, the last file in order of name wins."""
    raw = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    rows = raw.withColumn("__file", F.input_file_name()).where(F.col("_corrupt_record").isNull() & (existing(F.col(key)) != "")).drop("_corrupt_record")
    rest = [c for c in rows.columns if c not in (key, "__file")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("__file")).alias("r")).select(key, "r.*")


def read_locked_records(spark: SparkSession, path: str, name_field: str, prefix: str = "fo") -> DataFrame:
    """A JSON list of objects with a name each, and record_id (prefix_001 where blank); a broken contract raises."""
    items = read_json_list(spark, path).select("pos", F.from_json("text", "map<string,string>").alias("m"))
    at = lambda k: existing(F.try_element_at("m", F.lit(k)))
    rows = items.select((F.col("pos") + 1).alias("n"), F.col("m").alias("fields"), at(name_field).alias("name"), at("record_id").alias("id"))
    bad = rows.agg(F.count("*").alias("all"), F.count_if(F.col("name") == "").alias("unnamed")).first()
    if not bad["all"] or bad["unnamed"]:
        raise ValueError(f"expected a list of named objects: {bad['all']} items, {bad['unnamed']} without {name_field}")
    return rows.select(F.when(F.col("id") == "", F.format_string(f"{prefix}_%03d", "n")).otherwise(F.col("id")).alias("record_id"), "name", "fields")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL; blank lines are skipped, a broken line raises with its number and text. Lines are numbered only if one is broken."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if not lines.where(F.try_parse_json("value").isNull()).isEmpty():
        _, broken = read_numbered_json(spark, path, schema)
        first = broken.orderBy("file", "line_no").select("line_no", F.substring("value", 1, 80).alias("value")).first()
        raise ValueError(f"line {first.line_no}: not JSON: {first.value}")
    return lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


#: The fields of a golden question; lists that are missing are empty.
GOLDEN = "id string, category string, question string, gold_record_ids array<string>, expected_behavior string, must_include array<string>, must_exclude array<string>, expected_intent string, failure_mode string, notes string"


def read_golden(spark: SparkSession, path: str, default: list[dict]) -> DataFrame:
    """Questions with their gold records, as JSON lines; where there is no file, the default questions are written first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([tuple(q.get(f.name) for f in T._parse_datatype_string(GOLDEN)) for q in default], GOLDEN).coalesce(1).write.json(path)
    none = F.array().cast("array<string>")
    rows = read_json_lines(spark, path, GOLDEN)
    return rows.withColumns({c: F.coalesce(c, none) for c in ("gold_record_ids", "must_include", "must_exclude")} | {c: F.coalesce(c, F.lit("")) for c in ("expected_intent", "failure_mode", "notes")})


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """key, value from markdown lines '- key: number'."""
    form = r"^- ([A-Za-z0-9_@ ]+): *(-?[0-9.]+) *$"
    found = spark.read.text(path).select(F.regexp_extract("value", form, 1).alias("key"), F.regexp_extract("value", form, 2).try_cast("double").alias("value"))
    return found.where("key <> '' and value is not null")


def read_index(spark: SparkSession, path: str, required: list[str], version: int | None = None) -> DataFrame:
    """A stored index table with its required columns, and its version where one is asked for."""
    df = spark.read.parquet(path)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"index at {path} lacks {missing}")
    if version is not None and df.where(F.col("schema_version") != version).head(1):
        raise ValueError(f"index at {path} is of another version than {version}")
    return df


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, length, sha256 of the files below path: what a local-artifact test joins with."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def is_local_artifact(value: Column) -> Column:
    """Folders and suffixes of local artifacts."""
    return existing(value).rlike(r"^(reports|data|docs|scripts)/.*\.(md|csv|json|jsonl|xlsx|pdf|txt|log)$")


def read_workbook_column(spark: SparkSession, path: str, header: str, within: int = 10) -> DataFrame:
    """Distinct non-blank cells below a header cell in the first rows of an .xlsx sheet; none without file or header.

    A workbook is a small file by its format; it is parsed on the driver from binaryFile, which reads any store."""
    empty = spark.createDataFrame([], "name string")
    try:
        content = spark.read.format("binaryFile").load(path).select("content").first()
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    import io

    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(bytes(content[0]))) as z:
        shared = [] if "xl/sharedStrings.xml" not in z.namelist() else ["".join(x.text or "" for x in s.iter(f"{{{ns['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = next(n for n in sorted(z.namelist()) if n.startswith("xl/worksheets/sheet"))
        rows = ElementTree.fromstring(z.read(sheet)).findall("m:sheetData/m:row", ns)
    cells: dict[tuple[int, str], str] = {}
    for r in rows:
        for c in r.findall("m:c", ns):
            ref, value = c.get("r"), c.find("m:v", ns)
            text = "".join(x.text or "" for x in c.iter(f"{{{ns['m']}}}t")) if c.get("t") == "inlineStr" else "" if value is None else shared[int(value.text)] if c.get("t") == "s" else value.text
            cells[int(re.sub(r"\D", "", ref)), re.sub(r"\d", "", ref)] = text.strip()
    head = next(((r, c) for (r, c), v in sorted(cells.items()) if v == header and r <= within), None)
    if head is None:
        return empty
    names = dict.fromkeys(v for (r, c), v in sorted(cells.items()) if c == head[1] and r > head[0] and v)
    return spark.createDataFrame([(n,) for n in names], "name string")


def candidate_queries(name: Column) -> Column:
    """Search texts for an entity: its name, its simplified name, its first two distinctive tokens; no two alike but for case."""
    simple = registry_name(name)
    two = F.array_join(F.slice(F.filter(words(name), lambda w: F.length(w) > 2), 1, 2), " ")
    all_ = F.filter(F.array(existing(name), simple, two), lambda q: q != "")
    low = F.transform(all_, F.lower)
    return F.filter(all_, lambda q, i: F.array_position(low, F.lower(q)) == i + 1)


def source_urls(df: DataFrame, cell: str, order: str, limit: int | None = None) -> DataFrame:
    """Every URL of the cells in order of first sight, PDFs left out."""
    from ..functions.urls import url_list

    seen = df.select(order, F.posexplode(url_list(F.col(cell))).alias("at", "url")).where(~F.lower("url").endswith(".pdf"))
    first = seen.groupBy("url").agg(F.min(F.struct(order, "at")).alias("first")).orderBy("first")
    return (first if limit is None else first.limit(limit)).select("url")
