"""A content-addressed archive of WARC records.

``write`` stores each payload once under its SHA-256, and one row per record with the record's exact bytes
before the payload. ``records`` joins both and gives the records' original bytes back; ``read`` parses those
bytes. Large payloads are stored in buckets by digest, so reading moves the short heads to them and no payload;
one record carries each. Short payloads, which thousands of records may carry, are stored apart: their join is an
ordinary one that Spark can split where a digest is hot. Revisits only meet digests and sizes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.sources.tables import materialize, shared_root

#: Payloads from here on are written once and revisited.
REVISIT_FROM = 1000
#: Hot digests are dealt to so many tasks.
SALTS = 16
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


@dataclass
class Archive:
    heads: DataFrame
    #: Payloads from the revisit size on, in buckets, and shorter ones.
    large: DataFrame
    small: DataFrame


def head(kind: Column, page_id: Column, url: Column, sha1: Column, size: Column, refers_to: Column, date: str) -> Column:
    """Bytes of a record before its payload: WARC fields, blank line, HTTP fields, blank line."""
    revisit = kind == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size.cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    safe = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    name = lambda number: F.coalesce(number.cast("string"), F.lit("none"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind,
        F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), name(page_id),
        F.lit(f">{CRLF}WARC-Target-URI: "), safe,
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Payload-Digest: sha1:"), sha1,
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: <urn:page:"), name(refers_to), F.lit(">"))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), block.cast("string"),
        F.lit(CRLF * 2), http,
    )


def write(pages: DataFrame, least: int = REVISIT_FROM, date: str = DATE) -> Archive:
    """One record per row. Of equal payloads of ``least`` bytes or more the largest page_id is the response.

    Null html is an empty payload, a null url an empty one. Repeated rows of the largest page_id are all
    responses of the same stored payload; rows with a null id revisit it like others, and are responses where
    no row of the payload has an id. An empty table gives an empty archive.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    # ids and digests first, without payloads
    digested = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "page_id", "url", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").cast("long").alias("size"))
    narrow = materialize(digested, "digests")
    groups = narrow.where(F.col("size") >= least).groupBy("sha256").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = narrow.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    typed = dealt.join(salted, ["sha256", "salt"], "left")
    revisit = F.coalesce(~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull(), F.lit(False))
    kinds = typed.withColumn("kind", F.when(revisit, "revisit").otherwise("response")).withColumn("to", F.when(revisit, F.col("first")))
    heads = kinds.select(
        "page_id", "sha1", "sha256", "size",
        F.encode(head(F.col("kind"), F.col("page_id"), F.col("url"), F.col("sha1"), F.col("size"), F.col("to"), date), "utf-8").alias("head"),
        (F.col("kind") == "response").alias("carries"),
    )
    # each payload once
    store = pages.select(payload.alias("payload")).select(F.sha2("payload", 256).alias("sha256"), "payload")
    short = F.octet_length("payload") < least
    once = lambda rows: rows.groupBy("sha256").agg(F.first("payload").alias("payload"))
    name = f"warc_payloads_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = once(store.where(~short)).repartition(buckets, "sha256")
    # buckets need a name in the catalogue; the files lie in the shared folder and outlive the name
    folder = f"{shared_root(spark)}/corpuslens/{spark.sparkContext.applicationId}/{name}"
    large.write.bucketBy(buckets, "sha256").sortBy("sha256").option("compression", "zstd").option("path", folder).saveAsTable(name)
    bucketed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return Archive(materialize(heads, "heads"), bucketed, materialize(once(store.where(short)), "payloads"))


def records(archive: Archive, least: int = REVISIT_FROM) -> DataFrame:
    """page_id and the record's bytes: head, payload if it carries one, two line ends.

    ``sha1`` and ``size`` are taken from the stored payload, also for revisits, which do not carry it; ``intact`` tells whether
    it still has its strong digest.
    """
    carrying, revisits = archive.heads.where("carries"), archive.heads.where("NOT carries")
    facts = [F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"), (F.sha2("payload", 256) == F.col("sha256")).alias("intact")]
    heads = lambda rows: rows.select("page_id", "head", "sha256")
    whole = [
        heads(carrying.where(F.col("size") >= least)).join(archive.large, "sha256", "left"),
        heads(carrying.where(F.col("size") < least)).join(archive.small.hint("merge"), "sha256", "left"),
    ]
    ends = F.lit((CRLF * 2).encode())
    parts = [rows.select("page_id", F.concat("head", "payload", ends).alias("record"), *facts) for rows in whole]
    known = archive.large.select("sha256", *facts)
    parts.append(heads(revisits).join(known.hint("merge"), "sha256", "left").select("page_id", F.concat("head", ends).alias("record"), "sha1", "size", "intact"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """Fields parsed from the records' bytes; digests and sizes are taken anew from payloads.

    ``payload`` is null for revisits: it is that of the record they refer to. A record whose payload is missing or does
    not have its digest raises an error.
    """
    raw = records(archive)
    fields = F.decode(F.encode(F.substring_index(F.decode(F.col("record"), "iso-8859-1"), CRLF * 2, 1), "iso-8859-1"), "utf-8")
    top = F.substring_index(F.decode(F.col("record"), "iso-8859-1"), CRLF * 2, 2)
    # ISO 8859-1 gives one character per byte: character places are byte places
    parsed = raw.select("page_id", "sha1", "size", "intact", fields.alias("fields"), F.length(top).alias("skip"), "record")
    field = lambda name: F.regexp_extract("fields", rf"(?m)^{name}: (.*?)\r?$", 1)
    body = F.expr("substring(record, skip + 5, octet_length(record) - skip - 8)")
    kind = field("WARC-Type")
    content = F.when(kind != "revisit", body)
    out = parsed.select(
        F.regexp_extract(field("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).alias("id"),
        field("WARC-Target-URI").alias("url"), kind.alias("record_type"), content.alias("payload"),
        F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).alias("to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"sha1:(\w+)", 1).alias("digest"), "sha1", "size", "intact",
    )
    same = F.col("intact") & (F.col("sha1") == F.col("digest")) & (F.col("payload").isNull() | (F.sha1("payload") == F.col("digest")))
    broken = ~F.coalesce(same, F.lit(False))
    number = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    return out.select(
        number("id").alias("page_id"), "url", F.col("size").alias("payload_bytes"),
        F.when(broken, F.raise_error(F.concat(F.lit("payload does not have its digest: record "), F.col("id")))).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", number("to").alias("refers_to"), "payload",
    )
