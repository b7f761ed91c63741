"""Files of records: JSON lines, JSON documents, CSV, text; configuration; sinks and resuming."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.jsonish import strict_json
from corpusmill.functions.text import squeeze_space


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Strict: blank lines are skipped, a malformed one fails the query."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """(value, parsed, ok): every non-blank line, with its VARIANT if it is JSON."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.withColumn("parsed", strict_json(F.col("value"))).withColumn("ok", F.col("parsed").isNotNull())


def read_json_document(spark: SparkSession, path: str, key: str = "data") -> DataFrame:
    """A list of records, or an object that holds it under `key`."""
    df = spark.read.option("multiLine", True).json(path)
    if key in df.columns and isinstance(df.schema[key].dataType, T.ArrayType):
        df = df.select(F.explode(key).alias("r")).select("r.*")
    return df


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row, every value a string, quotes doubled."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def read_texts(spark: SparkSession, path: str, pattern: str = "*.{txt,md}") -> DataFrame:
    """(doc_id, text): whole files of a folder and those below, by name without suffix."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    return df.select(F.regexp_replace(F.col("_metadata.file_name"), "\\.[^.]*$", "").alias("doc_id"), F.col("value").alias("text"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: .json (a missing one falls back to .jsonl), .jsonl, .csv; anything else is an error."""
    suffix = Path(path).suffix
    if suffix == ".json":
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return read_json_document(spark, path)
        path, suffix = path[:-5] + ".jsonl", ".jsonl"
    if suffix == ".jsonl":
        return read_jsonl(spark, path)
    if suffix == ".csv":
        return read_csv(spark, path)
    raise ValueError(f"unsupported suffix {suffix!r}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text) of the .txt, .md and .docx files of a folder and those below, by name without suffix; a document's text is
    that of its paragraphs, those that say something, with a blank line between them. Files that can't be opened have null
    text. Bytes that are no UTF-8 are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,md,docx}").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [docx_text(body) if path.endswith(".docx") else body.decode("utf-8", "ignore") for path, body in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string())], names=["path", "text"])

    read = files.select("path", "content").mapInArrow(run, "path string, text string")
    return read.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), "\\.[^.]*$", "").alias("doc_id"), "text")


def docx_text(body: bytes) -> str | None:
    """Paragraphs of a word-processor file: text runs, tabs and breaks of its main part. Null for what is no such file."""
    import io
    import zipfile
    from xml.etree import ElementTree

    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    marks = {f"{space}tab": "\t", f"{space}br": "\n"}
    paragraphs = ["".join(x.text or "" if x.tag == f"{space}t" else marks.get(x.tag, "") for x in p.iter()).strip() for p in root.iter(f"{space}p")]
    return "\n\n".join(p for p in paragraphs if p)


def clean_texts(docs: DataFrame) -> DataFrame:
    """Texts of a folder with white space in order; those of which nothing is left go."""
    return docs.withColumn("text", squeeze_space(F.col("text"))).where("text <> ''")


def load_structured(path: str) -> Any:
    """A file's value by its suffix: .json, .yaml or .yml, .toml; text for .txt and .md. Anything else is an error."""
    import json
    import tomllib

    import yaml

    text, suffix = Path(path).read_text(encoding="utf-8"), Path(path).suffix
    readers = {".json": json.loads, ".yaml": yaml.safe_load, ".yml": yaml.safe_load, ".toml": tomllib.loads, ".txt": str, ".md": str}
    if suffix not in readers:
        raise ValueError(f"unsupported suffix {suffix!r}")
    return readers[suffix](text)


def dump_structured(value: Any, path: str) -> None:
    """The reverse of `load_structured`: a file takes the place of an old one at once, as a whole."""
    import json
    import os

    import yaml

    def toml(table: Mapping[str, Any], name: str = "") -> str:
        """Plain values first, then tables; lists of tables as such. A null can't be written."""
        one = lambda v: json.dumps(v, ensure_ascii=False) if not isinstance(v, list) else "[" + ", ".join(one(x) for x in v) + "]"
        of_tables = lambda v: isinstance(v, list) and v and all(isinstance(x, Mapping) for x in v)
        out = [f"{json.dumps(k)} = {one(v)}" for k, v in table.items() if not isinstance(v, Mapping) and not of_tables(v)]
        for k, v in table.items():
            full = f"{name}.{json.dumps(k)}" if name else json.dumps(k)
            if isinstance(v, Mapping):
                out.append(f"[{full}]\n{toml(v, full)}")
            elif of_tables(v):
                out += [f"[[{full}]]\n{toml(x, full)}" for x in v]
        return "\n".join(out)

    suffix = Path(path).suffix
    writers = {".json": lambda v: json.dumps(v, indent=2, ensure_ascii=False), ".yaml": lambda v: yaml.safe_dump(v, allow_unicode=True), ".yml": lambda v: yaml.safe_dump(v, allow_unicode=True), ".toml": toml, ".txt": str, ".md": str}
    if suffix not in writers:
        raise ValueError(f"unsupported suffix {suffix!r}")
    new = Path(f"{path}.new")
    new.write_text(writers[suffix](value), encoding="utf-8")
    os.replace(new, path)


def expand_paths(paths: list[str], suffix: str | None = None) -> list[str]:
    """Files, folders with all below them and patterns as one sorted list without repeats."""
    import glob

    found: set[str] = set()
    for p in paths:
        if Path(p).is_dir():
            found |= {str(x) for x in Path(p).rglob("*") if x.is_file()}
        elif glob.has_magic(p):
            found |= {x for x in glob.glob(p, recursive=True) if Path(x).is_file()}
        elif Path(p).is_file():
            found.add(p)
    return sorted(x for x in found if suffix is None or x.endswith(suffix))


def problems_with_samples(problems: DataFrame, samples: DataFrame, key: str = "task_id") -> DataFrame:
    """Samples with their problem; one of an unknown problem is left out."""
    return samples.join(problems, key)


def datapoint_kind(v: Column) -> Column:
    """What kind of call a traced JSON object is, by the keys that it has."""
    has = lambda name: F.try_variant_get(v, f"$.{name}", "variant").isNotNull()
    return (
        F.when(has("options"), "classify").when(has("min") & has("max"), "score").when(has("typ") & has("text"), "parse").when(has("typ"), "parse_force").when(has("instruction") & F.try_variant_get(v, "$.response", "boolean").isNotNull(), "binary_classify").when(has("instruction"), "generate")
    )


def checked_runs(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """Result files of a folder, a row each: (file, value, missing), missing the required fields that a file lacks, or `json`
    for one that can't be read."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    v = files.select("file", strict_json(F.col("text")).alias("value"))
    lost = F.filter(F.array(*[F.when(F.try_variant_get("value", f"$.{n}", "variant").isNull(), F.lit(n)) for n in required]), lambda x: x.isNotNull())
    return v.withColumn("missing", F.when(F.col("value").isNull(), F.array(F.lit("json"))).otherwise(lost))


def read_results(spark: SparkSession, path: str, key: str = "results") -> DataFrame:
    """Benchmark items: an object with a list under `key`, a list, or a single object."""
    return read_json_document(spark, path, key)


def with_run_parameters(df: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Adds the groups of `pattern` in each row's file name as columns."""
    return df.withColumns({n: F.regexp_extract(F.col("_metadata.file_name"), pattern, i + 1) for i, n in enumerate(names)})


def select_tasks(tasks: DataFrame, ids: list[str] | None = None, limit: int | None = None, key: str = "task_id") -> DataFrame:
    """Tasks by id list, all of which must exist, then the first `limit` by id."""
    if ids is not None:
        found = tasks.where(F.col(key).isin(ids))
        lost = set(ids) - {r[0] for r in found.select(key).distinct().limit(len(ids) + 1).collect()}
        if lost:
            raise KeyError(f"unknown tasks: {sorted(lost)}")
        tasks = found
    return tasks.orderBy(key).limit(limit) if limit is not None else tasks


def merge_config(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """Mappings merge key by key, everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge_config(out[k], v) if isinstance(out.get(k), Mapping) and isinstance(v, Mapping) else v
    return out


def load_config(path: str) -> dict[str, Any]:
    """A YAML file over the one that its `include` names, relative to it."""
    import yaml

    own = yaml.safe_load(Path(path).read_text()) or {}
    base = own.pop("include", None)
    return merge_config(load_config(str(Path(path).parent / base)), own) if base else own


def template_sections(text: str, markers: tuple[str, ...]) -> dict[str, str]:
    """Sections of a template, each from its marker line to the next one's."""
    out: dict[str, list[str]] = {}
    name = None
    for line in text.split("\n"):
        hit = next((m for m in markers if line.strip() == m), None)
        if hit:
            name = hit
            out.setdefault(name, [])
        elif name:
            out[name].append(line)
    return {k: "\n".join(v).strip() for k, v in out.items()}


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_routed(df: DataFrame, path: str, by: str = "route", mode: str = "overwrite") -> None:
    """One folder for each value, in one pass."""
    df.write.mode(mode).partitionBy(by).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_metrics(df: DataFrame, path: str) -> None:
    """A small result as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
