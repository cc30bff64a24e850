"""Files in many blocks, prefixes by order, predictors, pages, single files and alignments."""

import http.server
import itertools
import threading
import urllib.parse

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from sievemark.operators import alignment, carry, prefixes, providers, records
from sievemark.sources import files, paged, tools


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "64")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def blocks_of(spark, path):
    return files.numbered_lines(spark, path).select("n.block").distinct().count()


def test_sections_in_blocks(spark, tmp_path, small_blocks):
    lines, expected = ["position\taa\tscore"], []
    for i in range(7):
        lines.append(f">seq{i} tail")
        for p in range(1, 1 + 6 * (i % 4)):
            lines.append(f"{p}\tA\t{i + p / 8}")
            expected.append((f"seq{i}", p, i + p / 8))
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text(">other\n1\tC\t0.5\n")
    assert blocks_of(spark, str(tmp_path)) > 5
    found = tools.scan_epidope(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted([*expected, ("other", 1, 0.5)])


def test_population_report_in_blocks(spark, tmp_path, small_blocks):
    lines, expected = [], []
    for kind in ("I", "II", "combined"):
        lines += [f"class {kind}", "population/area\tcoverage\taverage_hit\tpc90"]
        for i in range(9):
            lines.append(f"Land{i}\t{i}.5%\t1.0\t2.0")
            expected.append((f"Land{i}", kind, i + 0.5, 1.0, 2.0))
        lines += ["average\t1\t1\t1", "", "population/area\thits\tpercent", *(f"Land{i}\t7\t9" for i in range(9)), ""]
    (tmp_path / "r.txt").write_text("\n".join(lines) + "\n")
    assert blocks_of(spark, str(tmp_path)) > 5
    assert sorted(map(tuple, files.scan_population_report(spark, str(tmp_path)).collect())) == sorted(expected)


def test_clusters_in_blocks(spark, tmp_path, small_blocks):
    rows, expected = [",".join(tools.CLUSTER_HEADER)], []
    for c in range(12):
        if c % 3:
            rows.append(f"{c}.1,Consensus,CONS{c},-,-,-")
        for m in range(1, 1 + c % 4):
            rows.append(f"{c}.1,{m},-AC,{m},id{c}{m},AC{m}")
            expected.append((f"{c}.1", f"CONS{c}" if c % 3 else "AC1", m, f"AC{m}"))
        if c % 3 and not c % 4:
            expected.append((f"{c}.1", f"CONS{c}", None, None))
    (tmp_path / "c.csv").write_text("\n".join(rows) + "\n")
    assert blocks_of(spark, str(tmp_path)) > 5
    found = tools.scan_cluster_csv(spark, str(tmp_path / "c.csv"))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found.select("cluster_id", "consensus", "member_ord", "sequence").collect()), key=key) == sorted(expected, key=key)
    assert [r[0] for r in found.select("cluster_ord").distinct().orderBy("cluster_ord").collect()] == list(range(1, 1 + len({e[0] for e in expected})))


def test_state_carried_over_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(f, i, int(v) if v < 3 else None) for f in "ab" for i, v in enumerate(rng.integers(0, 12, 60))]
    frame = spark.createDataFrame(rows, "file string, i int, v int").repartition(4)
    for before in (False, True):
        found = {(r.file, r.i): r.last for r in carry.carried_forward(frame, ["file"], F.expr("i div 7"), F.col("i"), {"last": F.col("v")}, before).collect()}
        for f, i, v in rows:
            known = [x for g, j, x in rows if g == f and (j < i or j == i and not before) and x is not None]
            assert found[f, i] == (known[-1] if known else None)
    sums = carry.running_sum(frame, ["file"], F.expr("i div 7"), F.col("i"), F.coalesce("v", F.lit(0)), "total")
    assert {(r.file, r.i): r.total for r in sums.collect()} == {(f, i): sum(x or 0 for g, j, x in rows if g == f and j <= i) for f, i, _ in rows}


def test_prefixes_by_order(spark):
    rng = np.random.default_rng(9)
    strings = sorted({"".join(rng.choice(list("abé𝒜"), int(n))) for n in rng.integers(1, 7, 400)})
    names, asked = strings[::2], strings[1::2] + ["zz", "a" * 50]
    related = {a: [n for n in names if n.startswith(a) or a.startswith(n)] for a in asked}
    frame = lambda x, c: spark.createDataFrame([(s,) for s in x], f"{c} string").repartition(4)
    found = prefixes.only_relatives(frame(asked, "said"), frame(names, "name")).collect()
    assert {tuple(r) for r in found} == {(a, n[0]) for a, n in related.items() if len(n) == 1}
    assert prefixes.only_relatives(frame([], "said"), frame(names, "name")).count() == 0


def test_a_short_identifier_of_many_names_is_an_error(spark):
    names = spark.createDataFrame([(f"Spike|{i}",) for i in range(300)], "name string")
    rows = spark.createDataFrame([("Spike|7",), ("Spike|29",), ("Spike|299#tail",)], "said string")
    assert {r.said: r.name for r in records.resolved(rows.where("said <> 'Spike|299#tail'"), names, "said", "name").collect()} == {"Spike|7": "Spike|7", "Spike|29": "Spike|29"}
    with pytest.raises(ValueError, match="no name or several"):  # begun by 2, 29 and 299
        records.resolved(rows, names, "said", "name").collect()
    with pytest.raises(ValueError, match="no name or several"):
        records.resolved(spark.createDataFrame([("Sp",)], "said string"), names, "said", "name").collect()


def test_residue_provider(spark):
    rows = spark.createDataFrame([("a", "ACD", 1), ("b", "", 2), ("c", None, 3), ("d", "WW", 4)], "sequence_id string, sequence string, position int")
    found = providers.residue_provider(lambda s: [ord(x) / 2 for x in s])(rows)
    assert sorted(map(tuple, found.collect())) == [("a", 1, 32.5), ("a", 2, 33.5), ("a", 3, 34.0), ("d", 1, 43.5), ("d", 2, 43.5)]
    with pytest.raises(PythonException, match="1 scores for d, which has 2 residues"):
        providers.residue_provider(lambda s: [1.0] * (len(s) - (s == "WW")))(rows).collect()


class Pages(http.server.BaseHTTPRequestHandler):
    """300 records; every page fails twice before it is given."""

    records = [(f"AC{i} virus", ("ACDEX" if i % 50 == 7 else "ACDE") + "FGHIK"[i % 5] * (i % 70 + 1)) for i in range(300)]
    asked: list[str] = []

    def do_GET(self):
        url = urllib.parse.urlparse(self.path)
        q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
        self.asked.append(self.path)
        if url.path == "/search":
            said = f"{len(self.records) if 'Spike' in q['term'] else 0} token 1"
        elif self.asked.count(self.path) < 3:
            self.send_error(503)
            return
        else:
            said = "junk\n" + "".join(f">{h}\n{s[:3]}\n{s[3:].lower()}\n" for h, s in self.records[int(q["start"]) : int(q["start"]) + int(q["size"])])
        self.send_response(200)
        self.end_headers()
        self.wfile.write(said.encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def service():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Pages.asked.clear()
    yield paged.HttpClient(f"http://127.0.0.1:{server.server_port}")
    server.shutdown()


def test_pages(spark, service, tmp_path):
    rows = paged.scan_pages(spark, service, "Spike", page=64, pause=0.01)
    assert rows.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, rows.collect())) == [(i, h, s) for i, (h, s) in enumerate(Pages.records)]
    with pytest.raises(ValueError, match="no records"):
        paged.scan_pages(spark, service, "Other", pause=0.01)
    kept = paged.fetch_reference_set(spark, service, "Spike", "Zaire x", 100, str(tmp_path), page=100, pause=0.01)
    first = {}
    for i, (h, s) in enumerate(Pages.records):
        if "X" not in s:
            first.setdefault(s, (i, h.split()[0], s))
    assert sorted(map(tuple, kept.collect())) == sorted(first.values())
    assert any("50%3A150" in x for x in Pages.asked)
    said = spark.read.json(f"{tmp_path}/Spike_Zaire_x.provenance-*").first()
    assert (said.n, said.n_ambiguous, said.n_kept) == (300, 6, len(first))
    n = len(Pages.asked)
    assert paged.fetch_reference_set(spark, service, "Spike", "Zaire x", 100, str(tmp_path)).count() == len(first) and len(Pages.asked) == n


def test_a_page_that_never_comes_is_an_error(spark, service):
    with pytest.raises(PythonException, match="503"):
        paged.scan_pages(spark, service, "Spike", page=300, attempts=2, pause=0.01).collect()


def test_one_file(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"x{i}" if i % 3 else None, i / 8, i % 2 == 0, 'a "b"\tc' if i == 5 else " s ") for i in range(500)], "n int, name string, score double, flag boolean, note string").repartition(7)
    path = tmp_path / "t.tsv"
    files.sink_tsv_file(rows, ["n"], str(path), ["name", "score", "flag", "gone", "note"])
    lines = path.read_text().split("\n")
    assert lines[0] == "name\tscore\tflag\tgone\tnote" and lines[-1] == "" and len(lines) == 502
    assert lines[1] == "\t0\tTrue\t\t s " and lines[6] == 'x5\t0.625\tFalse\t\t"a ""b""\tc"'
    with pytest.raises(FileExistsError):
        files.sink_tsv_file(rows, ["n"], str(path), ["name"])
    files.sink_fasta_file(rows.select("n", F.col("name").alias("header"), F.lit("ACDEFGH").alias("sequence")).where("name is not null and n < 9"), ["n"], str(tmp_path / "f.fa"), 5)
    assert (tmp_path / "f.fa").read_text() == "".join(f">x{i}\nACDEF\nGH\n" for i in range(9) if i % 3)
    files.as_one_file(spark.createDataFrame([], "value string"), ["value"], str(tmp_path / "e"), ["head"])
    assert (tmp_path / "e").read_text() == "head\n"
    with pytest.raises(Exception, match="broken"):
        files.as_one_file(rows.select("n", F.when(F.col("n") == 400, F.raise_error(F.lit("broken"))).otherwise("x").alias("value")), ["n"], str(tmp_path / "b"))
    assert not [x for x in tmp_path.iterdir() if x.name.startswith("b") or "parts" in x.name or "whole" in x.name]


def best(x, y, match=2, mismatch=-1, first=-4, more=-1):
    """The best score by trying, with a memory: state 0 letters, 1 gap of y, 2 gap of x."""
    seen = {}

    def go(i, j, state):
        if (i, j) == (0, 0):
            return 0 if state == 0 else -(10**6)
        if (i, j, state) not in seen:
            out = -(10**6)
            if state == 0 and i and j:
                out = max(go(i - 1, j - 1, s) for s in range(3)) + (match if x[i - 1] == y[j - 1] else mismatch)
            if state == 1 and i:
                out = max(go(i - 1, j, s) + (more if s == 1 else first) for s in range(3))
            if state == 2 and j:
                out = max(go(i, j - 1, s) + (more if s == 2 else first) for s in range(3))
            seen[i, j, state] = out
        return seen[i, j, state]

    return max(go(len(x), len(y), s) for s in range(3))


def score_of(x, y, edits):
    i = j = total = 0
    former = ""
    for e in edits:
        if e == "M":
            total += 2 if x[i] == y[j] else -1
        else:
            total += -1 if former == e else -4
        i, j, former = i + (e != "I"), j + (e != "D"), e
    assert (i, j) == (len(x), len(y))
    return total


def test_pairs_are_aligned_best():
    rng = np.random.default_rng(6)
    pairs = [("".join(rng.choice(list("ACé"), int(n))), "".join(rng.choice(list("ACé"), int(m)))) for n, m in rng.integers(0, 12, (150, 2))]
    for (x, y), (score, edits) in zip(pairs, alignment.aligned_pairs(pairs)):
        assert score == best(x, y) == score_of(x, y, edits)
    for (x, y), (score, edits) in zip(pairs, alignment.aligned_pairs(pairs, band=2)):
        assert score == score_of(x, y, edits) <= best(x, y)
    near = [("ACDEFGHIKL" * 4, "ACDEFHIKL" * 4)]
    assert alignment.aligned_pairs(near, band=6)[0][0] == alignment.aligned_pairs(near)[0][0]


def test_alignments_of_groups(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CELLS", 2000)
    rng = np.random.default_rng(8)
    rows = []
    for g in range(4):
        root = "".join(rng.choice(list("ACDEFGHIKL"), 20))
        for i in range(12):
            s = list(root)
            for _ in range(int(rng.integers(0, 4))):
                at = int(rng.integers(len(s)))
                s[at : at + int(rng.integers(0, 3))] = list(rng.choice(list("WY"), int(rng.integers(0, 3))))
            rows.append((g, i, "".join(s), 1))
    rows += [(0, 99, "", 1), (0, 98, None, 1), (7, 1, "", 1)]
    found = alignment.align(spark.createDataFrame(rows, "group int, ord int, sequence string, score int").repartition(3)).collect()
    assert {(r.group, r.ord, r.sequence) for r in found} == {(g, o, s or "") for g, o, s, _ in rows}
    for g, own in itertools.groupby(sorted(found, key=lambda r: r.group), key=lambda r: r.group):
        own = list(own)
        assert len({len(r.alignment) for r in own}) == 1
        assert all(r.alignment.replace("-", "") == r.sequence for r in own)
        centre = next((r for r in own if r.score == 2 * len(r.sequence)), None)
        for r in own if centre else []:
            assert r.score == best(centre.sequence, r.sequence)
            # Without the columns in which both have gaps the alignment to the centre is worth its score.
            edits = "".join("M" if a != "-" and b != "-" else "D" if a != "-" else "I" for a, b in zip(centre.alignment, r.alignment) if (a, b) != ("-", "-"))
            assert score_of(centre.sequence, r.sequence, edits) == r.score
        assert not any(all(r.alignment[c] == "-" for r in own) for c in range(len(own[0].alignment)))
    assert alignment.align(spark.createDataFrame([], "group int, ord int, sequence string")).count() == 0


def test_failing_proteins_can_end_a_run(spark):
    rows = spark.createDataFrame([("a", 0.2, False), ("b", 0.9, True)], "sequence_id string, score double, antigenic boolean")
    assert records.drop_failing_proteins(rows).count() == 2
    with pytest.raises(ValueError, match="a, 0.2"):
        records.drop_failing_proteins(rows, True)
    assert records.drop_failing_proteins(rows.where("antigenic"), True).count() == 1


def test_numbers_of_second_suppliers(spark):
    rows = spark.createDataFrame([(f"p{i}", i, f"id{i}", "Spike", None if i % 2 else "Zaire", "ACDEFGHIKL") for i in range(6)], "path string, ord int, id string, protein_label string, strain string, sequence string")
    found = records.find_problems(rows, 5).collect()
    assert {r.path for r in found} == {"p2", "p3", "p4", "p5"}
    assert all(("p0" if r.path in ("p2", "p4") else "p1") in r.problem or r.path in ("p3", "p5") for r in found)
