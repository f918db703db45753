"""Content keys (SHA-2 / SHA-1 fingerprints)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
NULL_TOKEN = "x"          # stands for NULL in the null-safe row fingerprint
FINGERPRINT_SEP = "|"
ENTITY_SEP = "_"
PACK_SEP, PACK_MARK = "\x1f", "\x1e"      # between packed columns; before a sign that stands for something else
PACK_TYPES = ("string", "int", "bigint")
# ---------------------------------------------------------------------------


def row_fingerprint(cols) -> Column:
    """SHA-256 over every column, NULL-safe (a NULL becomes 'x')."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws(FINGERPRINT_SEP, *parts), 256)


def entity_key(cols, sep: str = ENTITY_SEP) -> Column:
    """SHA-256 over the columns joined by ``sep``; NULLs are skipped, so
    ('A', NULL, 'B') and ('A', 'B') share a key (kept for parity)."""
    return F.sha2(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]), 256)


def zone_year_sha256(zone: str, year: str) -> Column:
    return F.sha2(F.concat_ws(FINGERPRINT_SEP, F.col(zone).cast("string"),
                              F.col(year).cast("string")), 256)


def zone_year_sha1(zone: str, year: str) -> Column:
    return F.sha1(F.concat(F.col(zone).cast("string"), F.col(year).cast("string")))


def packed_key(col: str) -> Column:
    """A key as bytes for a shuffle: the 64 hex digits of a SHA-256 as 32 bytes
    (hex digits hardly compress), any other text as its own bytes, with one
    more from 32 on, so different texts never meet."""
    c = F.col(col)
    digest, plain = F.unhex(c), c.cast("binary")
    return F.when((F.octet_length(c) == 64) & (F.lower(F.hex(digest)) == c), digest) \
        .otherwise(F.when(F.octet_length(c) >= 32, F.concat(plain, F.unhex(F.lit("00")))).otherwise(plain))


def unpacked_key(col: str) -> Column:
    """The text of a ``packed_key``."""
    c = F.col(col)
    size = F.octet_length(c)
    return F.when(size == 32, F.lower(F.hex(c))) \
        .otherwise(F.when(size > 32, F.substring(c, F.lit(1), size - 1)).otherwise(c).cast("string"))


def packed_columns(df: DataFrame, keep=(), out: str = "_row"):
    """-> (rows, unpack): ``df`` is ``unpack(rows)``.  Texts and whole numbers but
    those of ``keep`` travel as one text: a row of many short columns is mostly
    lengths and padding.  Rows are equal exactly when their packed forms are."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = [c for c in df.columns if types[c] in PACK_TYPES and c not in keep]
    if len(cols) < 2:
        return df, lambda d: d
    mark = {s: F.lit(PACK_MARK + s) for s in "0123"}     # NULL, mark, separator, bytes that are no UTF-8
    sep, plain = F.lit(PACK_SEP), F.lit(PACK_MARK)

    def pack(c):
        v = F.col(f"`{c}`")
        if types[c] == "string":
            v = F.when(F.is_valid_utf8(v), F.replace(F.replace(v, plain, mark["1"]), sep, mark["2"])).otherwise(F.concat(mark["3"], F.hex(v)))
        return F.coalesce(v.cast("string"), mark["0"])

    def unpacked(c):
        v = F.get("_parts", cols.index(c))
        if types[c] != "string":
            return F.when(v != mark["0"], v).cast(types[c])
        text = F.replace(F.replace(v, mark["2"], sep), mark["1"], plain)
        return F.when(v == mark["0"], F.lit(None)).when(v.startswith(mark["3"]), F.unhex(F.substr(v, F.lit(3))).cast("string")).otherwise(text)

    def unpack(d):
        # other columns may have come or gone meanwhile
        here = [c for c in df.columns if c in cols or c in d.columns]
        added = [c for c in d.columns if c not in here and c != out]
        return d.withColumn("_parts", F.split(out, PACK_SEP)).select(
            *[(unpacked(c) if c in cols else F.col(f"`{c}`")).alias(c, metadata=df.schema[c].metadata) for c in here],
            *[f"`{c}`" for c in added])
    return df.select(*[f"`{c}`" for c in df.columns if c not in cols], F.concat_ws(PACK_SEP, *map(pack, cols)).alias(out)), unpack
