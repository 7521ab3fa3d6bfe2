import re
import zlib

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return (text or "").translate(ASCII_LOWER)


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def frame(spark, rows, extra=()):
    """A documents table out of (doc_id, text[, lang, source]); more columns may clash with what operators use inside."""
    schema = DOCUMENTS + "".join(f", {name} string" for name in extra)
    full = [(i, t, *(list(rest) + ["en", "s"][len(rest):]), None if t is None else len(t), *("x" for _ in extra)) for i, t, *rest in rows]
    return spark.createDataFrame(full, schema)


#: Names that the operators use for columns of their own.
CLASHING = ("words", "size", "rows", "copies", "text_id", "key", "weight", "slices", "before", "plan", "row", "hash", "entry", "set", "prefix",
            "group", "component", "shard", "slot", "score", "found", "slice", "copy", "pass", "axis0", "curve", "k1", "k2", "taken", "label")
