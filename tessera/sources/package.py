"""Sources: CSV packages in a ZIP, CSV and JSON files, settings; and small sinks."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import tempfile
import tomllib
import zipfile
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.errors import SourceError
from tessera.sources.store import StorePath, at

#: Members of a concept package, the columns each must have, and whether the
#: package must have the member.
MEMBERS: dict[str, tuple[str, tuple[str, ...], bool]] = {
    "occupations": ("occupations_en.csv", ("conceptType", "conceptUri", "iscoGroup", "preferredLabel", "altLabels", "hiddenLabels", "status", "modifiedDate", "code"), True),
    "groups": ("ISCOGroups_en.csv", ("conceptUri", "code", "preferredLabel"), True),
    "broader": ("broaderRelationsOccPillar_en.csv", ("conceptUri", "broaderUri"), True),
    "skills": ("occupationSkillRelations_en.csv", ("occupationUri", "relationType", "skillType", "skillUri"), True),
    "research": ("researchOccupationsCollection_en.csv", ("conceptUri",), False),
    "shares": ("greenShareOcc_en.csv", ("conceptUri", "greenShare"), False),
}
#: A ZIP can't be split, so it passes the driver; larger packages belong in plain files.
MOST_BYTES = 1 << 30


@dataclass(frozen=True)
class Package:
    """Tables of text columns by name, each member's SHA-256, and the ZIP's."""

    tables: Mapping[str, DataFrame]
    checksums: Mapping[str, str]
    checksum: str
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


def find_member(names: Iterable[str], basename: str, required: bool = True) -> str | None:
    """The one member of that base name in any folder, whatever its case."""
    found = [n for n in names if n.replace("\\", "/").rsplit("/", 1)[-1].casefold() == basename.casefold()]
    if len(found) > 1:
        raise SourceError(f"{basename}: {len(found)} members have this name")
    if not found and required:
        raise SourceError(f"{basename} is missing")
    return found[0] if found else None


def parse_csv(name: str, data: bytes) -> tuple[list[str], list[list[str]]]:
    """Header and rows of a UTF-8 CSV: quoted line ends stay; the header's names are
    trimmed, filled and different; a row may be short (filled with "") but not long; rows
    of blanks alone are dropped."""
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError as e:
        raise SourceError(f"{name}: not UTF-8") from e
    rows = csv.reader(io.StringIO(text, newline=""), strict=True)
    try:
        header = [h.strip() for h in next(rows, [])]
        if not header or "" in header or len(set(header)) < len(header):
            raise SourceError(f"{name}: the header needs different, filled names")
        out = []
        for row in rows:
            if len(row) > len(header):
                raise SourceError(f"{name}, line {rows.line_num}: {len(row)} values for {len(header)} columns")
            if any(v.strip() for v in row):
                out.append(row + [""] * (len(header) - len(row)))
    except csv.Error as e:
        raise SourceError(f"{name}: {e}") from e
    return header, out


def require_columns(name: str, columns: Iterable[str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise SourceError(f"{name}: columns {', '.join(missing)} are missing")


def as_table(spark: SparkSession, header: list[str], rows: list[list[str]]) -> DataFrame:
    schema = T.StructType([T.StructField(h, T.StringType()) for h in header] + [T.StructField("_row", T.LongType())])
    columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(header))]
    return spark.createDataFrame(pa.table([*columns, pa.array(range(len(rows)), pa.int64())], names=[*header, "_row"]), schema)


def load_package(spark: SparkSession, path: str, members: Mapping[str, tuple[str, tuple[str, ...], bool]] = MEMBERS) -> Package:
    """Reads a ZIP from any file system that Spark reads. Tables carry _row, the place in
    the file; optional members that aren't there are no tables."""
    size = spark.read.format("binaryFile").load(path).select("length").first()
    if size is None or size.length > MOST_BYTES:
        raise SourceError(f"{path}: no package of at most {MOST_BYTES} bytes")
    data = bytes(spark.read.format("binaryFile").load(path).select("content").first().content)
    tables, checksums, columns = {}, {}, {}
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise SourceError(f"{path}: not a ZIP") from e
    with archive:
        for name, (basename, required, must) in members.items():
            member = find_member(archive.namelist(), basename, must)
            if member is None:
                continue
            raw = archive.read(member)
            header, rows = parse_csv(basename, raw)
            require_columns(basename, header, required)
            tables[name], checksums[name], columns[name] = as_table(spark, header, rows), hashlib.sha256(raw).hexdigest(), tuple(header)
    return Package(tables, checksums, hashlib.sha256(data).hexdigest(), columns)


def split_package(source: str, target: str, basenames: Iterable[str]) -> None:
    """Copies some members of a local ZIP to another."""
    with zipfile.ZipFile(source) as a, zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as b:
        for name in basenames:
            member = find_member(a.namelist(), name)
            b.writestr(member, a.read(member))


def read_csv(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """A large CSV as text columns, in parallel; a row with more values than columns goes
    to _corrupt_record whole, as do short ones, whose missing values are null there."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt_record"]])
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def collection_uris(table: DataFrame, column: str = "conceptUri") -> DataFrame:
    """Distinct trimmed values of a membership column, blanks dropped."""
    return table.select(F.trim(column).alias(column)).where(F.col(column) != "").distinct()


def profile(package: Package, members: Mapping[str, tuple[str, tuple[str, ...], bool]] = MEMBERS) -> dict[str, dict]:
    """Rows, columns, extra columns and checksum of each table."""
    return {
        name: {"rows": df.count(), "columns": list(package.columns[name]), "extra": sorted(set(package.columns[name]) - set(members[name][1])), "sha256": package.checksums[name]}
        for name, df in package.tables.items()
    }


#: The fields of postings and of the taxonomy.
_CATEGORY = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "name", "url", "group", "level1Id", "level2Id", "level3Id")])
POSTING = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("externalId", "status", "platformId", "sourceUrl", "title", "description", "requireCandidate", "experience")]
    + [
        T.StructField("updatedAt", T.StructType([T.StructField("$date", T.StringType())])),
        T.StructField("requireSummary", T.ArrayType(T.StringType())),
        T.StructField("knowledge", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())]))),
        T.StructField("commonInfo", T.MapType(T.StringType(), T.StringType())),
        T.StructField("categories", T.ArrayType(_CATEGORY)),
    ]
)
TAXONOMY = T.StructType([T.StructField(c, T.StringType()) for c in ("externalId", "name", "parentExternalId")])


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Postings of a JSON array, or of one object a line."""
    return spark.read.json(path, schema=POSTING, multiLine=True)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, parent_id); ids are filled and different."""
    rows = spark.read.json(path, schema=TAXONOMY, multiLine=True)
    rows = rows.select(F.trim("externalId").alias("id"), F.trim("name").alias("name"), F.nullif(F.trim("parentExternalId"), F.lit("")).alias("parent_id"))
    bad = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("id IS NULL OR id = '' OR n > 1").limit(10).collect()
    if bad:
        raise SourceError(f"taxonomy ids blank or repeated: {', '.join(str(r.id) for r in bad)}")
    return rows


def load_settings(path: str | None, defaults: Mapping, env: Mapping[str, str] | None = None, prefix: str = "TESSERA_") -> dict:
    """Settings of a TOML or JSON file over defaults, under the environment (PREFIX + NAME,
    read as JSON where it is JSON). Unknown names are errors."""
    found = dict(defaults)
    if path:
        raw = Path(path).read_bytes()
        given = json.loads(raw) if path.endswith(".json") else tomllib.loads(raw.decode())
        unknown = sorted(set(given) - set(defaults))
        if unknown:
            raise SourceError(f"{path}: unknown settings {', '.join(unknown)}")
        found |= given
    for name in defaults:
        if (value := (os.environ if env is None else env).get(prefix + name.upper())) is not None:
            try:
                found[name] = json.loads(value)
            except ValueError:
                found[name] = value
    return found


def write_json(path: str | Path | StorePath, value: object) -> None:
    """Pretty JSON of a report, replaced as a whole or not at all."""
    path = at(path)
    if isinstance(path, StorePath):
        path.write_text(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str))
        return
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=".", suffix=".tmp")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True, default=str)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def markdown_table(columns: list[str], rows: Iterable[Iterable]) -> str:
    """A Markdown table; bars and line ends in cells are escaped."""
    cell = lambda v: str("" if v is None else v).replace("\\", "\\\\").replace("|", "\\|").replace("\n", "<br>")
    lines = [columns, ["---"] * len(columns), *rows]
    return "\n".join("| " + " | ".join(map(cell, line)) + " |" for line in lines) + "\n"
