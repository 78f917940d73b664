"""Quality rules by cross-document line frequency, with DataFrame functions only.

The base rules judge one text: too few words, or too many words in 5-word windows that the
text repeats.  The cross-document rule hashes normalised lines, counts for each host the
distinct documents that carry a line, removes lines above the host's limit and rejects
documents that are left with too little.

Per document everything is an array function inside the row (one sort of packed longs finds
repeated windows), so no word is ever shuffled.  Only (host, line) pairs move, at most one per
document and distinct line, counted with map-side combine, so a hot host or a line found in a
third of all documents arrives as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.llm.common import WORD, store

WINDOW = 5


def _length(c: Column) -> Column:
    return F.length(c).cast("bigint")


def repeated_window_words(words: Column, width: int = WINDOW) -> dict[str, Column]:
    """Words in ``width``-word windows whose sequence occurs twice or more in the array, first included.

    A window's 64-bit hash gives its high bits and its position the low bits of one long; sorted,
    equal windows stand together.  What shares its high bits with a neighbour is compared once more
    by the whole hash, so a long text, whose positions take more bits, is judged as exactly as a short one.
    """
    n = F.size(words) - (width - 1)
    bits = F.length(F.bin(n))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - F.lit(1)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    window = lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(width)])
    top = lambda v: v.bitwiseAND(F.bitwise_not(F.col("_mask")))
    packed = F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: top(window(i)).bitwiseOR(i.cast("bigint"))))

    def repeated(array: str, name) -> Column:
        """The elements of a sorted array that share their name with a neighbour."""
        same = lambda v, j: F.coalesce(name(F.get(F.col(array), j)) == name(v), F.lit(False))
        return F.filter(F.col(array), lambda v, j: same(v, j - 1) | same(v, j + 1))

    place = lambda v: v.bitwiseAND(F.col("_mask"))
    whole = F.sort_array(
        F.transform(repeated("_p", top), lambda v: F.struct(window(place(v).cast("int")).alias("h"), place(v).alias("i")))
    )
    starts = F.sort_array(F.transform(repeated("_q", lambda v: v["h"]), lambda v: v["i"]))
    covered = F.aggregate(
        F.transform(
            F.col("_s"),
            lambda v, j: F.least(F.lit(width).cast("bigint"), F.coalesce(F.get(F.col("_s"), j + 1) - v, F.lit(width).cast("bigint"))),
        ),
        F.lit(0).cast("bigint"),
        lambda acc, v: acc + v,
    )
    # Each part is a column of its own (see ``text_rules``), so that nothing is computed twice.
    return {"_h": hashes, "_mask": mask, "_p": packed, "_q": whole, "_s": starts, "covered": covered}


def text_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and ``_lines``.

    Null and empty texts have no words and fail.  ``_lines`` holds each distinct normalised line
    (lower case, runs of white space as one space, digits as 0) with its number of words and how
    often it occurs; it feeds ``line_counts``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    with_word = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    out = docs.withColumn("_w", words).withColumn("_l", with_word)
    part = repeated_window_words(F.col("_w"))
    out = out.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "word_chars": _length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")),
            "n_symbols": _length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "_h": part["_h"],
            "_mask": part["_mask"],
        }
    )
    out = out.withColumn("_p", F.when(F.size("_w") > WINDOW, part["_p"]).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("_q", part["_q"]).withColumn("_s", part["_s"]).withColumn("n_repeat_words", part["covered"])
    failed = (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))
    lines = F.transform(F.col("_l"), lambda x: F.struct(line_hash(x).alias("line"), word_count(x).alias("words")))
    return out.withColumn("base_failed", failed).withColumn("_lines", lines).drop("_w", "_l", "_h", "_mask", "_p", "_q", "_s")


def line_hash(line: Column) -> Column:
    """Hash of a line without regard to case, kinds of white space and the value of digits."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.trim(plain))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def frequent_lines(judged: DataFrame, share: float, min_docs: int) -> DataFrame:
    """(host, line, first_doc) of lines in more than ``share`` of a host's documents and in more than ``min_docs``.

    Documents that hold the same text count once, so a group of exact copies does not turn a
    document's own lines into boilerplate.  ``first_doc`` is the smallest id that has the line.
    """
    each = judged.select("_host", "doc_id", "_content", F.explode(F.array_distinct("_lines.line")).alias("line"))
    distinct = each.groupBy("_host", "line", "_content").agg(F.min("doc_id").alias("doc_id"))
    counted = distinct.groupBy("_host", "line").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")
    ).where(F.col("n") > min_docs)
    sizes = judged.groupBy("_host", "_content").agg(F.lit(1).alias("x")).groupBy("_host").agg(F.count("x").alias("docs"))
    return counted.join(sizes, counted["_host"].eqNullSafe(sizes["_host"])).where(
        F.col("n") > F.lit(share) * F.col("docs")
    ).select(counted["_host"], "line", "first_doc")


def judge_documents(
    docs: DataFrame, host: str = "source", share: float = 0.05, min_docs: int = 20, min_left: float = 0.1
) -> DataFrame:
    """One row per input row: the base counts, base_failed, kept, n_removed_words and ``_removed`` line hashes.

    A line above its host's limit is removed from every document but the one with the smallest
    doc_id, so nothing is lost from the corpus.  A document that keeps no more than ``min_left``
    of its words is depleted; kept is false for it and for one that fails the base rules.
    Null hosts form one host.  Repeated rows and rows without doc_id are judged row by row; the
    latter never count as a line's first document while another has it.  Other columns, whatever
    their names, are not read.
    """
    judged = docs.select("doc_id", F.col(host).cast("string").alias("_host"), F.col("text").alias("_text"))
    judged = text_rules(judged, "_text").withColumn("_content", F.xxhash64(F.coalesce(F.col("_text"), F.lit(""))))
    judged = store(judged.drop("_text"), "line-rules")
    often = frequent_lines(judged, share, min_docs)
    each = judged.select("_host", "doc_id", F.explode(F.array_distinct("_lines.line")).alias("line")).alias("e")
    o = often.alias("o")
    hit = each.join(
        o, (F.col("e.line") == F.col("o.line")) & F.col("e._host").eqNullSafe(F.col("o._host"))
    ).where(~F.col("e.doc_id").eqNullSafe(F.col("o.first_doc")))
    # At most one document's distinct lines meet here.
    removed = hit.groupBy(F.col("e._host").alias("h"), F.col("e.doc_id").alias("d")).agg(
        F.collect_set("e.line").alias("_removed")
    )
    out = judged.join(removed, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("_host").eqNullSafe(F.col("h")), "left")
    out = out.withColumn("_removed", F.coalesce("_removed", F.array().cast("array<bigint>")))
    lost = F.aggregate(
        F.filter("_lines", lambda x: F.array_contains("_removed", x["line"])),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x["words"],
    )
    out = out.withColumn("n_removed_words", lost)
    depleted = (F.col("n_removed_words") > 0) & (
        F.col("n_words") - F.col("n_removed_words") <= F.lit(min_left) * F.col("n_words")
    )
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("_lines", "h", "d")


def clean_documents(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without rejected documents and, in the others, without removed lines (n_chars follows the text).

    Null and empty texts have no words and are rejected.  Rows that repeat, or have no doc_id, stay or go
    each by the verdict on its own text; an empty table gives an empty one.
    """
    verdicts = judge_documents(docs, **limits).select(
        F.col("doc_id").alias("_d"), F.col("_host").alias("_h"), "_content", "_removed", "kept"
    ).where("kept").distinct()
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    host = F.col(limits.get("host", "source")).cast("string")
    # Ids, host and content pick the verdict of the row itself, also where ids repeat.
    joined = docs.join(
        verdicts, docs["doc_id"].eqNullSafe(F.col("_d")) & host.eqNullSafe(F.col("_h")) & (content == F.col("_content"))
    )
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_removed", line_hash(x))), "\n")
    text = F.when(F.size("_removed") > 0, left).otherwise(F.col("text"))
    changes = {"text": text}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.length(text).cast("bigint")
    return joined.withColumns(changes).select(*docs.columns)
