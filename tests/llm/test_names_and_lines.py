"""Names after titles of every kind, and frequent lines removed, against plain counts."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import line_quality, surrogates

NAMES = {
    "Dr Maria Anna Sophia Weber came. Weber left.": ["Maria", "Anna", "Sophia", "Weber", "Weber"],
    "Dr Ludwig van Beethoven played.": ["Ludwig", "Beethoven"],
    "Dr Łukasz Nowak, then Łukasz": ["Łukasz", "Nowak", "Łukasz"],
    "Ms Šárka Žižková": ["Šárka", "Žižková"],
    "Dr. Γιώργος Παπαδόπουλος": ["Γιώργος", "Παπαδόπουλος"],
    "MR JOHN SMITH": ["JOHN", "SMITH"],
    "mr. Smith and Mr Smith Mrs Jones": ["Smith", "Smith", "Jones"],
    "Prof Juan de la Cruz y Mora": ["Juan", "Cruz"],
    "The doctor, dr. who, sir and a sire; Drama Queen": [],
}


@pytest.mark.parametrize("text", NAMES)
def test_names_after_titles(text):
    assert [text[a:b] for a, b, kind, _ in surrogates.entities(text) if kind == "name"] == NAMES[text]


def test_names_are_replaced_in_their_script(spark):
    rows = list(enumerate(NAMES))
    got = {r.doc_id: r.text for r in surrogates.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        for name in NAMES[text]:
            assert not re.search(rf"(?<!\w){name}(?!\w)", got[i]), got[i]
    assert got[8] == rows[8][1]
    assert re.fullmatch(r"Dr\. [Ͱ-Ͽ]+ [Ͱ-Ͽ]+", got[4]) and "van" in got[1] and got[5] == got[5].upper()


def test_lines_have_two_hashes(spark):
    """The second is no function of the first: of lines that share a first hash by force, seconds differ."""
    row = spark.range(1).select(*line_quality._uid(F.lit("a line"))).first()
    again = spark.range(1).select(F.xxhash64(F.lit("a line"), F.lit(7))).first()[0]
    assert row[0] != row[1] != again


@pytest.mark.parametrize("percent", [0, 30])
def test_removed_lines_against_counts(spark, percent):
    rng = np.random.default_rng(12)
    lines = ["Accept all cookies 12", "  accept ALL cookies 7", "Share this page", "", " ", "One of few", "Ünïque * # line", *[f"word{i} text of its own" for i in range(40)]]
    rows = [(i, f"host{i % 3}" if i % 10 else None, "\n".join(str(x) for x in rng.choice(lines, int(rng.integers(1, 9)))), 1) for i in range(90)] + [(200, "host1", None, 1), (201, "host1", "", 1), (None, "host1", "Share this page", 1)]
    plain = lambda x: re.sub("[0-9]+", "0", x.strip(" \t\n\x0b\x0c\r").lower())
    seen, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for i, host, text, _ in rows:
        if i is not None:
            hosts[host].add(i)
        for x in (text or "").split("\n"):
            if plain(x) and i is not None:
                seen[host, plain(x)].add(i)
    gone = {k for k, v in seen.items() if len(v) >= 8 and 100 * len(v) >= percent * len(hosts[k[0]])}
    assert gone
    expected = collections.Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if (h, plain(x)) not in gone), sum((h, plain(x)) in gone for x in (t or "").split("\n"))) for i, h, t, _ in rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, depleted int").repartition(3)
    found = line_quality.without_frequent_lines(docs, limit_docs=8, limit_percent=percent)
    assert collections.Counter((r.doc_id, r.text, r.n_frequent_lines) for r in found.collect()) == expected
    assert line_quality.without_frequent_lines(docs.limit(0)).count() == 0
