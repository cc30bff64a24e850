"""Quality rules from cross-document line frequency, in built-in expressions only.

Lines are normalised (stripped, lower case, digits as 0) and hashed; distinct
documents are counted per host and line with partial sums. A line above the
host's limit is removed wherever the host has it, and a document that loses more
than a share of its characters is rejected, as are those that fail the base rules.

Defined results. Null or empty text: no words, base_failed. A null host is a host
of its own; a null doc_id does not count as a document. Equal rows get equal
results and are counted once. Lines and texts are told apart by two hashes of 64 bits with
different seeds. Texts of any length are read whole; as arrays of their words and lines they
take several times their size in one task. An empty table gives an empty one. Lines that are equally
frequent share their fate. Columns of docs named as those that an operator adds are replaced; names that
begin with __ are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.stage import checkpointed, without

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
#: Positions of up to this many words are sorted together with the hash's upper bits.
_PACKED = 22


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _bare(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def base_counts(docs: DataFrame) -> DataFrame:
    """docs (text and others) with the counts instead of text."""
    rest = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_bare(x)) > 0)
    d = docs.select(
        *rest,
        F.when(F.length(_bare(text)) > 0, F.split(_bare(text), "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>")).alias("__words"),
        F.length(_without(text, _BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
    )
    counts = [*rest, F.size("__words").cast("long").alias("n_words"), "word_chars", "n_symbols", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines")]
    names = [*rest, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # Hashes of all 3-word windows, then those that occur twice: upper bits and position sort as one long.
    grams = F.when(F.size("__words") >= 3, F.expr("transform(sequence(0, size(__words) - 3), i -> xxhash64(__words[i], __words[i + 1], __words[i + 2]))")).otherwise(F.array().cast("array<bigint>"))
    d = d.select(*counts, grams.alias("__grams"))
    d = d.select(*names, "__grams", F.sort_array(F.expr(f"transform(__grams, (g, i) -> shiftleft(shiftright(g, {_PACKED}), {_PACKED}) | bigint(i))")).alias("__packed"))
    near = f"shiftright(p, {_PACKED}) = shiftright(get(__packed, j - 1), {_PACKED}) or shiftright(p, {_PACKED}) = shiftright(get(__packed, j + 1), {_PACKED})"
    maybe = F.when(F.size("__grams") <= 1 << _PACKED, F.expr(f"transform(filter(__packed, (p, j) -> coalesce({near}, false)), p -> int(p & {(1 << _PACKED) - 1}))")).otherwise(F.expr("sequence(0, size(__grams) - 1)"))
    d = d.select(*names, "__grams", maybe.alias("__maybe"))
    d = d.select(*names, F.sort_array(F.expr("transform(__maybe, i -> struct(__grams[i] as g, i as i))")).alias("__exact"))
    same = "e.g = get(__exact, j - 1).g or e.g = get(__exact, j + 1).g"
    d = d.select(*names, F.sort_array(F.expr(f"transform(filter(__exact, (e, j) -> coalesce({same}, false)), e -> e.i)")).alias("__at"))
    covered = F.expr("aggregate(transform(__at, (p, j) -> bigint(least(3, coalesce(get(__at, j + 1) - p, 3)))), 0L, (s, x) -> s + x)")
    return d.select(*names, covered.alias("n_repeat_words"))


def _slim(docs: DataFrame, host: str) -> tuple[Column, Column, Column]:
    return F.col("doc_id").cast("long"), F.col(host).cast("string"), F.coalesce(F.col("text").cast("string"), F.lit(""))


def _uid(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def frequent_lines(docs: DataFrame, host: str, limit_docs: int, limit_percent: int) -> DataFrame:
    """Rows that have frequent lines (g_doc_id, g_host, g_t1, g_t2): how many, their characters, and where they stand."""
    d = docs.select(*(c.alias(n) for c, n in zip(_slim(docs, host), ("doc_id", "host", "text"), strict=True)))
    uid = [c.alias(n) for c, n in zip(_uid(F.col("text")), ("t1", "t2"), strict=True)]
    key = ["doc_id", "host", "t1", "t2"]
    normal = lambda x: F.regexp_replace(F.lower(_bare(x)), "[0-9]+", "0")
    hashed = lambda df, *keep: df.select(*keep, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    distinct = d.select("doc_id", "host", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).select("doc_id", "host", normal(F.col("line")).alias("line")).where("line != ''")
    hosts = d.groupBy("host").agg(F.count_distinct("doc_id").alias("n_host"))
    counted = hashed(distinct, "doc_id", "host").groupBy("host", "h1", "h2").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") >= limit_docs)
    frequent = counted.join(hosts, counted.host.eqNullSafe(hosts.host)).where(F.col("n") * 100 >= F.col("n_host") * limit_percent).select(counted.host.alias("f_host"), F.col("h1").alias("f1"), F.col("h2").alias("f2"))
    lines = d.select("doc_id", "host", *uid, F.posexplode(F.split("text", "\n")).alias("at", "line")).select(*key, "at", F.length(_without(F.col("line"), _BLANKS)).alias("chars"), normal(F.col("line")).alias("line")).where("line != ''")
    lines = hashed(lines, *key, "at", "chars")
    hit = lines.join(frequent, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & F.col("host").eqNullSafe(F.col("f_host"))).groupBy(*key, "at").agg(F.max("chars").alias("chars"))
    return hit.groupBy(*(F.col(c).alias(f"g_{c}") for c in key)).agg(F.count("*").alias("n_frequent_lines"), F.sum("chars").alias("frequent_chars"), F.collect_list("at").alias("frequent_at"))


def _same(doc_id: str, host: str, t1: str, t2: str) -> Column:
    return (F.col(t1) == F.col("g_t1")) & (F.col(t2) == F.col("g_t2")) & F.col(doc_id).eqNullSafe(F.col("g_doc_id")) & F.col(host).eqNullSafe(F.col("g_host"))


def without_frequent_lines(docs: DataFrame, host: str = "source", limit_docs: int = 20, limit_percent: int = 1, deplete_percent: int = 50) -> DataFrame:
    """docs with text without the lines above the limit, their number and characters, and depleted, as line_frequency judges.

    The other lines, blank ones too, stay as they are and in their order; null text stays null.
    """
    docs = without(docs, ["n_frequent_lines", "frequent_chars", "depleted"])
    gone = frequent_lines(docs, host, limit_docs, limit_percent)
    doc_id, own_host, text = _slim(docs, host)
    t1, t2 = _uid(text)
    keyed = docs.select("*", doc_id.alias("__doc_id"), own_host.alias("__host"), t1.alias("__t1"), t2.alias("__t2"))
    joined = keyed.join(gone, _same("__doc_id", "__host", "__t1", "__t2"), "left")
    # The places left come from a set difference, so that a long text of frequent lines takes linear time.
    left = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), F.col("frequent_at"))
    joined = joined.select("*", F.split("text", "\n").alias("__lines"), F.when(F.col("frequent_at").isNotNull(), left).alias("__left"))
    zero = F.lit(0).cast("long")
    chars = F.coalesce("frequent_chars", zero)
    new = F.when(F.col("__left").isNull(), F.col("text").cast("string")).otherwise(F.array_join(F.expr("transform(__left, i -> __lines[i])"), "\n"))
    return joined.select(
        *(new.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.coalesce("n_frequent_lines", zero).alias("n_frequent_lines"),
        chars.cast("long").alias("frequent_chars"),
        (chars * 100 > F.length(_without(F.coalesce(F.col("text").cast("string"), F.lit("")), _BLANKS)) * deplete_percent).alias("depleted"),
    )


def line_frequency(docs: DataFrame, host: str = "source", limit_docs: int = 20, limit_percent: int = 1, deplete_percent: int = 50) -> DataFrame:
    """Counts and verdict for each row of docs (doc_id, text, and the host column).

    A line is above the limit if at least limit_docs documents and limit_percent
    per cent of its host's documents have it. A document is depleted if such lines
    hold more than deplete_percent per cent of word_chars.
    """
    d = docs.select(*(c.alias(n) for c, n in zip(_slim(docs, host), ("doc_id", "host", "text"), strict=True)))
    uid = [c.alias(n) for c, n in zip(_uid(F.col("text")), ("t1", "t2"), strict=True)]
    # Written, so that no filter on the result is pushed into the nested array expressions and repeats them.
    base = checkpointed(base_counts(d.select("doc_id", "host", *uid, "text")))
    gone = frequent_lines(docs, host, limit_docs, limit_percent)
    zero = F.lit(0).cast("long")
    out = base.join(gone, _same("doc_id", "host", "t1", "t2"), "left").select(*base.columns, F.coalesce("n_frequent_lines", zero).alias("n_frequent_lines"), F.coalesce("frequent_chars", zero).cast("long").alias("frequent_chars"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("frequent_chars") * 100 > F.col("word_chars") * deplete_percent
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_frequent_lines", "frequent_chars")
