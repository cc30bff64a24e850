"""Language identification by Bayesian fusion of evidence.

For every language the log posterior of a page is the sum of
  its text's likelihood under byte trigrams counted over all labelled documents,
  how often pages of that language declare what this page's markup declares,
  how often their paths or first host labels hint at what this one's hint at,
  how often their addresses end in this one's suffix, whatever it is,
  and a prior of its host, smoothed towards the host's domain and that towards all
  pages; these counts come from grouped aggregation over the languages that the
  pages' texts alone suggest. A page's own text is taken out of all counts that it
  is judged by, so that it speaks once.

Defined results. A page without text is judged by declaration, address and host.
A null url belongs to an empty host, with an empty suffix. With no labelled document
the language is null, with a confidence of 0. Of languages with equal posteriors the
first by name is taken. Pages that repeat are pages of their own, and count each.
Pages are read whole, in time that grows with their length. An empty table gives an
empty one. Columns with the names of the results are replaced; names that begin
with __ are the operator's own.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import textscan
from sievemark.llm.stage import checkpointed, without

CELLS = 1 << 15
#: Trigrams of a text depend on each other: their evidence counts this much.
TEMPER = 0.1
#: Pages' worth of weight that a host's prior gives its domain's, and a domain's the overall one.
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 10.0
#: Pages' worth of weight that a suffix's share over all languages has in that of one.
SUFFIX_WEIGHT = 20.0
#: What pages are counted by, with a join and not a table on the driver: the values are without bound.
_GROUPS = ("host", "domain", "suffix")
NONE, OTHER = "", "?"

#: What opens a part that is not read, and what closes it.
_OPEN = re.compile(r"(?i)<(?:(script|style|noscript|template)\b|!--)")
_CLOSE = {"": re.compile("-->")} | {x: re.compile(rf"(?i)</{x}\s*>") for x in ("script", "style", "noscript", "template")}
_TAG = re.compile(r"(?s)<[^>]*>")
# Attributes are looked for in the first 4096 characters of a tag, so that tags that never end cost no more.
_HTML_TAG, _META_TAG = (re.compile(rf"(?is)<{x}\b([^>]{{0,4096}})") for x in ("html", "meta"))
_LANG = re.compile(r"""(?is)(?:^|[\s"'/])lang\s*=\s*["']?([A-Za-z]{2,3})\b""")
_LANGUAGE_META = re.compile(r"(?is)content-language|og:locale")
_CONTENT = re.compile(r"""(?is)content\s*=\s*["']?([A-Za-z]{2,3})(?![A-Za-z])""")
_URL = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://([^/?#:]*)(?::\d+)?(/[^?#]*)?")


def visible(html: str) -> str:
    """The text between tags, without scripts, styles and comments; one that is not closed is read on."""
    parts: list[str] = []
    at = look = 0
    unclosed: set[str] = set()
    while m := _OPEN.search(html, look):
        name = (m[1] or "").lower()
        end = None if name in unclosed else _CLOSE[name].search(html, m.end())
        if end is None:
            unclosed.add(name)
            look = m.end()
        else:
            parts.append(html[at : m.start()])
            at = look = end.end()
    text = " ".join([*parts, html[at:]])
    last = text.rfind(">") + 1
    return entities.unescape(_TAG.sub(" ", text[:last]) + text[last:])


def declared(html: str) -> str:
    for m in _HTML_TAG.finditer(html):
        if said := _LANG.search(m[1]):
            return said[1].lower()
    for m in _META_TAG.finditer(html):
        if _LANGUAGE_META.search(m[1]) and (said := _CONTENT.search(m[1])):
            return said[1].lower()
    return NONE


def address(url: str, known: set[str]) -> tuple[str, str, str, str]:
    """(host, domain, suffix, language that the path's or the host's first labels hint at)."""
    m = _URL.match(url)
    host = (m[1] if m else "").lower()
    labels = [x for x in host.split(".") if x]
    path = [x.lower() for x in (m[2] or "").split("/") if x][:2] if m else []
    hint = next((x[:2] for x in [*path, *labels[:-1][:1]] if x in known or x[:2] in known and re.fullmatch("[a-z]{2}[-_][a-z]{2}", x)), NONE)
    return host, ".".join(labels[-2:]), labels[-1] if labels else NONE, hint


def trigrams(column: pa.Array) -> Iterator[tuple[textscan.Texts, np.ndarray, np.ndarray]]:
    """Hash cells of the byte trigrams of each text's words (blanks and marks as one blank), and their text."""
    for t in textscan.chunks(column):
        data = textscan.FOLD[t.data].copy()
        letter = textscan.ALNUM[data] & ((data < 0x30) | (data > 0x39))
        data[~letter] = 0x20
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        own = data[keep].astype(np.uint64)
        doc = (np.searchsorted(t.offsets, np.flatnonzero(keep), "right") - 1).astype(np.int64)
        if len(own) < 3:
            yield t, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        h = textscan.mix(own[:-2] << np.uint64(16) | own[1:-1] << np.uint64(8) | own[2:]) & np.uint64(CELLS - 1)
        same = doc[2:] == doc[:-2]
        yield t, h[same].astype(np.int64), doc[2:][same]


def trigram_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of the cells in each, from all labelled documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in textscan.bounded(batches):
            langs = batch.column("lang").to_pylist()
            for t, cell, doc in trigrams(batch.column("text")):
                names = langs[t.first : t.first + len(t)]
                for lang in set(names):
                    own = np.array([x == lang for x in names])
                    n = np.bincount(cell[own[doc]], minlength=CELLS)
                    total[lang] = total[lang] + n if lang in total else n
        for lang, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])], names=["lang", "cell", "n"])

    slim = docs.select(F.lower(F.trim(F.col("lang").cast("string"))).alias("lang"), F.col("text").cast("string").alias("text")).where("lang != ''")
    rows = slim.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    langs = sorted(set(rows["lang"]))
    n = np.full((len(langs), CELLS), 0.05)
    for lang, cell, x in zip(rows["lang"], rows["cell"], rows["n"], strict=True):
        n[langs.index(lang), cell] += x
    return langs, np.log(n / n.sum(axis=1, keepdims=True)) if langs else n


def identify(pages: DataFrame, labelled: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages without html, with host, suffix, declared, hint, text_lang, lang, and confidence (the posterior of lang)."""
    found = ["host", "suffix", "declared", "hint", "text_lang"]
    pages = without(pages, [*found, "domain", "lang", "confidence", "likelihood", *(f"{c}_counts" for c in _GROUPS)])
    pages = pages.withColumn(url, F.col(url).cast("string")).withColumn(html, F.col(html).cast("string"))
    names = pages.columns
    spark = pages.sparkSession
    langs, logp = trigram_model(labelled)
    size = len(langs)
    known = set(langs)
    shared = spark.sparkContext.broadcast(logp.astype(np.float32))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = shared.value
        for batch in textscan.bounded(batches, html):
            urls, bodies = batch.column(url).to_pylist(), batch.column(html).to_pylist()
            places = [address(u or "", known) for u in urls]
            said = [declared(b or "") for b in bodies]
            said = [x if x in known or x == NONE else OTHER for x in said]
            likelihood = np.zeros((batch.num_rows, size))
            for t, cell, doc in trigrams(pa.array([visible(b or "") for b in bodies], pa.string())):
                for i in range(size):
                    likelihood[t.first : t.first + len(t), i] = np.bincount(doc, weights=logp[i, cell], minlength=len(t))[: len(t)] * TEMPER
            best = [langs[i] if some else None for i, some in zip(likelihood.argmax(axis=1), likelihood.any(axis=1), strict=True)] if size else [None] * batch.num_rows
            host, domain, suffix, hint = zip(*places, strict=True) if places else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *(pa.array(x, pa.string()) for x in (host, domain, suffix, said, hint, best)), pa.array(list(likelihood), pa.list_(pa.float64()))], names=[*names, "host", "domain", "suffix", "declared", "hint", "text_lang", "likelihood"])

    schema = pages.select("*", *(F.lit(None).cast("string").alias(x) for x in ("host", "domain", "suffix", "declared", "hint", "text_lang")), F.array().cast("array<double>").alias("likelihood")).schema
    # The page's body is not carried through the shuffles below.
    rest = [c for c in names if c != html]
    evidence = checkpointed(pages.mapInArrow(read, schema).select(*rest, "host", "domain", "suffix", "declared", "hint", "text_lang", "likelihood"))
    guessed = evidence.where("text_lang is not null")
    # At most (languages + 2) values each.
    tables = {c: {(r[c], r.text_lang): r.n for r in guessed.groupBy(c, "text_lang").agg(F.count("*").alias("n")).collect()} for c in ("declared", "hint")}
    overall = np.array([sum(n for (_, t), n in tables["declared"].items() if t == x) for x in langs], float)
    values = sorted({NONE, OTHER, *langs})
    counts = {c: np.array([[tables[c].get((v, x), 0) for x in langs] for v in values], float).reshape(len(values), size) for c in tables}
    vector = F.array(*(F.sum((F.col("text_lang") == x).cast("double")) for x in langs)) if size else F.array().cast("array<double>")
    joined = evidence
    for c in _GROUPS:
        # Written, so that both sides of the join are plain shuffles, of which a partition with a large host can be split.
        own = checkpointed(guessed.groupBy(F.col(c).alias("__of")).agg(vector.alias(f"{c}_counts")))
        joined = joined.join(own, F.col(c) == F.col("__of"), "left").drop("__of")
    schema = pages.select(*rest, *(F.lit(None).cast("string").alias(x) for x in (*found, "lang")), F.lit(0.0).alias("confidence")).schema

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {v: i for i, v in enumerate(values)}
        for batch in batches:
            n = batch.num_rows
            if size:
                self = np.array([[float(x == t) for x in langs] for t in batch.column("text_lang").to_pylist()]).reshape(n, size)
                total = np.array(batch.column("likelihood").to_pylist(), float).reshape(n, size)
                pages_of = overall - self
                for c, table in counts.items():
                    own = table[[at[v] for v in batch.column(c).to_pylist()]].reshape(n, size) - self
                    total = total + np.log((own + 0.5) / (pages_of + 0.5 * len(values)))
                host, domain, suffix = (np.array([[y or 0.0 for y in x or [0.0] * size] for x in batch.column(f"{c}_counts").to_pylist()], float).reshape(n, size) - self for c in _GROUPS)
                share = (pages_of + 1) / (pages_of + 1).sum(axis=1, keepdims=True)
                # How often a language's addresses have this suffix, smoothed towards how often any have.
                any_ = (suffix.sum(axis=1, keepdims=True) + 0.5) / (pages_of.sum(axis=1, keepdims=True) + 1)
                total = total + np.log((suffix + SUFFIX_WEIGHT * any_) / (pages_of + SUFFIX_WEIGHT))
                domain = (domain + DOMAIN_WEIGHT * share) / (domain.sum(axis=1, keepdims=True) + DOMAIN_WEIGHT)
                host = (host + HOST_WEIGHT * domain) / (host.sum(axis=1, keepdims=True) + HOST_WEIGHT)
                total = total + np.log(host)
                total = total - total.max(axis=1, keepdims=True)
                lang, sure = [langs[i] for i in total.argmax(axis=1)], 1 / np.exp(total).sum(axis=1)
            else:
                lang, sure = [None] * n, np.zeros(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in [*rest, *found]), pa.array(lang, pa.string()), pa.array(sure)], names=[*rest, *found, "lang", "confidence"])

    return joined.mapInArrow(fuse, schema)


def report(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return identify(slim, labelled).select("page_id", "host", "suffix", "declared", "hint", "text_lang", "lang", F.round("confidence", 6).alias("confidence"))
