"""Policy bundles: ZIP archives and loose JSON files, read as tables of documents."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaferry.functions.jsondoc import is_json

# Kinds of bundle members by a part of their name, first match counts.
MEMBER_KINDS = (
    ("data_quality_policy_definitions", "Data Quality Policy Definitions"),
    ("data_drift_policy_definitions", "Data Drift Policy Definitions"),
    ("schema_drift_policy_definitions", "Schema Drift Policy Definitions"),
    ("reconciliation_policy_definitions", "Reconciliation Policy Definitions"),
    ("profile_anomaly_policy_definition", "Profile Anomaly Policy Definition"),
    ("data_cadence_policy_definitions", "Data Cadence Policy Definitions"),
    ("business_rules", "Business Rules"),
    ("asset_udf_variables", "Asset UDF Variables"),
    ("data_sources", "Data Sources"),
    ("notification_settings", "Notification Settings"),
    ("package_udf_definitions", "Package UDF Definitions"),
    ("reference_asset", "Reference Asset"),
)

_MEMBERS = "bundle string, member string, content binary, error string"


def text_of(content: Column) -> Column:
    """Bytes as text: UTF-8, or Latin-1 where they are not valid UTF-8."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))


def member_kind(member: Column) -> Column:
    kind = F.lit("Other/Unknown")
    for part, name in reversed(MEMBER_KINDS):
        kind = F.when(member.contains(part), name).otherwise(kind)
    return kind


def is_policy_member(member: Column) -> Column:
    """JSON files of data quality policies at the root of an archive."""
    return member.startswith("data_quality_policy") & member.endswith(".json")


# What one task may hold of an archive; Spark reads no file beyond 2 GB as one value.
LARGEST_ARCHIVE = 2_000_000_000
# Members are handed on in groups of about this many bytes.
_CHUNK_BYTES = 8 << 20


# Fixed values of the ZIP format: size and signature of the header before a member, flags of encrypted and patched members.
_HEADER = struct.Struct("<4s2xH18xHH")
_SIGNATURE = b"PK\x03\x04"
_UNUSUAL = 0x1 | 0x20 | 0x40


def _plain_member(content: bytes, info: zipfile.ZipInfo, end_of_room: int) -> bytes | None:
    """A stored or deflated member in which everything is as it should be; None if the library has to look at it."""
    start = info.header_offset
    if info.flag_bits & _UNUSUAL or not 0 <= start <= len(content) - _HEADER.size:
        return None
    signature, _, name_size, extra_size = _HEADER.unpack_from(content, start)
    name = content[start + _HEADER.size : start + _HEADER.size + name_size]
    begin = start + _HEADER.size + name_size + extra_size
    end = begin + info.compress_size
    if signature != _SIGNATURE or not name.isascii() or name.decode() != info.orig_filename or end > min(end_of_room, len(content)):
        return None
    data = content[begin:end]
    if info.compress_type == zipfile.ZIP_DEFLATED:
        unpacking = zlib.decompressobj(-15)
        try:
            data = unpacking.decompress(data, info.file_size + 1)
        except zlib.error:
            return None
        if not unpacking.eof:
            return None
    elif info.compress_type != zipfile.ZIP_STORED:
        return None
    return data if len(data) == info.file_size and zlib.crc32(data) == info.CRC else None


def _archive_rows(bundle: str, content: bytes) -> Iterator[tuple]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, ValueError, NotImplementedError) as problem:
        yield bundle, None, None, f"bad archive: {problem}"
        return
    members = [m for m in archive.namelist() if not m.endswith("/")]
    if not members:
        yield bundle, None, None, "empty archive"
    # A member has room up to the next one; where two begin at one place the library tells what is wrong.
    starts = sorted(info.header_offset for info in archive.infolist())
    room = dict(zip(starts, [*starts[1:], archive.start_dir])) if len(set(starts)) == len(starts) else {}
    for member in members:
        try:
            info = archive.getinfo(member)
            data = _plain_member(content, info, room.get(info.header_offset, -1))
            yield bundle, member, archive.read(member) if data is None else data, None
        except Exception as problem:  # noqa: BLE001  damaged, encrypted or unknown packing: one error row
            yield bundle, member, None, f"unreadable member: {problem}"


def _open_archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["bundle", "member", "content", "error"]
    rows, held = [], 0
    for batch in batches:
        for bundle, content in zip(batch["bundle"], batch["content"]):
            for row in _archive_rows(bundle, content):
                rows.append(row)
                held += 100 + len(row[2] or b"")
                if held > _CHUNK_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
    yield pd.DataFrame(rows, columns=names)


def open_bundles(archives: DataFrame) -> DataFrame:
    """Members of ``archives(bundle, content)``; a broken or empty archive gives one error row.

    Unpacking is the one step Spark has no expression for. Members leave it in
    small groups, so a task never holds more than an archive and such a group.
    """
    members = archives.select("bundle", "content").mapInPandas(_open_archives, _MEMBERS)
    is_json = F.lower("member").endswith(".json")
    return members.select(
        "bundle",
        "member",
        F.when(is_json, text_of(F.col("content"))).alias("text"),
        F.when(~is_json, F.col("content")).alias("content"),
        member_kind(F.col("member")).alias("kind"),
        "error",
    )


def below(root: str, path: Column) -> Column:
    """A file's path relative to the folder that was read; files of the same name stay apart."""
    plain = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/")
    return F.regexp_replace(path, f"^(?:[a-z0-9]+:)?/*{re.escape(plain.lstrip('/'))}/+", "")


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Members of all ZIP archives below a folder, whatever the case of their suffix.

    ``bundle`` is the path below the folder. An archive is opened in one task, so
    one of over ``LARGEST_ARCHIVE`` bytes is not read and gives an error row.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .load(path)
    )
    bundle = below(path, F.col("path")).alias("bundle")
    small = open_bundles(files.filter(F.col("length") <= LARGEST_ARCHIVE).select(bundle, "content"))
    return small.unionByName(
        files.filter(F.col("length") > LARGEST_ARCHIVE).select(
            bundle,
            *[F.lit(None).cast(kind).alias(name) for name, kind in small.dtypes if name not in ("bundle", "error")],
            F.format_string("archive of %d bytes is too large", "length").alias("error"),
        )
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Loose JSON files below a folder: path and text."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(path)
    )
    return files.select("path", text_of(F.col("content")).alias("text"))


def usable_bundles(members: DataFrame) -> DataFrame:
    """Bundles that can be imported: archives with members and without errors."""
    return (
        members.groupBy("bundle")
        .agg(F.count("member").alias("members"), F.count("error").alias("errors"))
        .filter((F.col("members") > 0) & (F.col("errors") == 0))
        .select("bundle", "members")
    )


def objects_of(documents: DataFrame, schema: str, text: str = "text") -> DataFrame:
    """Objects of documents that are one object or a list of objects; texts that are not JSON have none."""
    others = [c for c in documents.columns if c != text]
    return documents.filter(is_json(F.col(text))).select(*others, F.explode(F.from_json(text, f"array<{schema}>")).alias("_o")).select(
        *others, "_o.*"
    )


def reconcile_bundles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Member counts of each bundle on both sides and whether they agree."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("member").isNotNull()).groupBy("bundle").agg(F.count(F.lit(1)).alias(name))

    both = counted(before, "members_in").join(counted(after, "members_out"), "bundle", "full_outer")
    total_in, total_out = (F.coalesce(c, F.lit(0)).alias(c) for c in ("members_in", "members_out"))
    return both.select("bundle", total_in, total_out).withColumn(
        "status", F.when(F.col("members_in") == F.col("members_out"), "ok").otherwise("count_mismatch")
    )
