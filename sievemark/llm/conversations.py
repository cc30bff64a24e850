"""Repair of conversations by lazy weighted determinisation.

A conversation is repaired by cheapest edits so that its roles read (s?(ua)+)?. The
grammar's automaton has four states: nothing said, after the system's turn, after a
user's and after an assistant's. With edits it is weighted: a turn is kept, gets
another role or is deleted, and turns are inserted. It is determinised lazily: a state
of the deterministic automaton is the vector of least costs of the four states, less
its least entry; where it goes with a kind of turn, and what that costs, is worked out
once and kept in a transition table, so a conversation's cost is a scan of that table. From the
end, arcs that are tight, whose costs agree with the least ones, are traced back; the
states that they pass are a function of the deterministic state, the kind of turn and
the states behind it, and are kept in a table, too. Along them the audit takes the least letter
each time. Of one state and one letter there is one arc, so the audit alone says what
becomes of every turn.

Faults are found in rows that carry a digest of the text in its place; turns that repeat
in full are one row with a count, and only texts that a conversation says in several
turns are joined. The rows are dealt by ranges of conversation and turn, so a long
conversation is split, and packed to a byte a turn. Such strings of a conversation
meet in one task, as does its audit, which is a value of the result. The texts are
shuffled once; a task applies the audits to the sorted stream of turns and hashes it as it
passes.

Defined results. conv_id, role and text that are null count as one space, a null turn
as one space where its key is hashed. Turns are taken in order, null ones first; of one turn, by role
and then by the MD5 of the text. A role's initial is its first character, in its
case; other initials than s, u and a cannot be kept. Blank, duplicate and truncated
turns are told by whole texts of any length. Rows without conv_id are one conversation whose id is
null. Repeated rows are turns of their own, the later ones duplicates. A conversation
of which nothing is left has zeros, an empty audit and the hash of nothing. An empty
table gives an empty one. Only conv_id, turn, role and text are read, and columns of
other names are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.stage import checkpointed, shuffle_partitions

BLANK = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1
#: States: nothing said, after s, after u, after a. What a turn of the given initial does to each, if anything.
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The role that an inserted or renamed turn gets in each state, and the state after it.
_ROLE, _AFTER = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
_FINAL = (0, 3)
_FAR = 1 << 40
#: A turn's kind: its initial (3: another one), with 4 if it is truncated, and 8 or 16 if it is blank or a duplicate.
_KEPT, _TRUNCATED, _BLANK, _DUPLICATE = "sua", 4, 8, 16
#: Initials that may follow each other.
_LEGAL = ((0, 1), (1, 2), (2, 1))


class Repairer:
    """The lazily determinised automaton with its tables."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.after: dict[tuple[int, int], tuple[int, int]] = {}
        self.tight: dict[tuple[int, int, int], int] = {}
        self.start = self._state([0, _FAR, _FAR, _FAR])[0]

    def _state(self, costs: list[int]) -> tuple[int, int]:
        """The number of the vector with insertions carried out, and the cost taken off it."""
        for _ in range(2):
            for q, cost in enumerate(list(costs)):
                costs[_AFTER[q]] = min(costs[_AFTER[q]], cost + INSERT, _FAR)
        least = min(costs)
        key = tuple(x - least if x < _FAR else _FAR for x in costs)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(key)
        return self.number[key], least

    @staticmethod
    def arcs(q: int, kind: int) -> list[tuple[str, int, int]]:
        """(letter, cost, next state) of what can become of a turn in state q, letters ascending."""
        out = [("D", DELETE, q)]
        if kind < _BLANK:
            cut = CUT if kind & _TRUNCATED else 0
            initial = kind & 3
            if initial < 3 and (to := _NEXT[_KEPT[initial]][q]) is not None:
                out.append(("K", cut, to))
            out.append(("R", REROLE + cut, _AFTER[q]))
        return out

    def step(self, state: int, kind: int) -> tuple[int, int]:
        if (found := self.after.get((state, kind))) is None:
            costs = [_FAR] * 4
            for q, cost in enumerate(self.vectors[state]):
                for _, more, to in self.arcs(q, kind):
                    costs[to] = min(costs[to], cost + more, _FAR)
            found = self.after[state, kind] = self._state(costs)
        return found

    def _inserted(self, vector: tuple[int, ...], mask: int) -> int:
        """The states of a mask and those that tight insertions lead to it from."""
        for _ in range(2):
            for q in range(4):
                if vector[q] < _FAR and mask >> _AFTER[q] & 1 and vector[q] + INSERT == vector[_AFTER[q]]:
                    mask |= 1 << q
        return mask

    def behind(self, state: int, kind: int, mask: int) -> int:
        """The states at `state` from which tight arcs of a turn lead into mask."""
        if (found := self.tight.get((state, kind, mask))) is None:
            to, offset = self.step(state, kind)
            vector, after = self.vectors[state], self.vectors[to]
            found = 0
            for q, cost in enumerate(vector):
                if cost < _FAR and any(mask >> t & 1 and cost + more == after[t] + offset for _, more, t in self.arcs(q, kind)):
                    found |= 1 << q
            found = self.tight[state, kind, mask] = self._inserted(vector, found)
        return found

    def repair(self, kinds: bytes | np.ndarray) -> tuple[int, str]:
        """(cost, audit) of a conversation given by its turns' kinds."""
        path, total, state = np.empty(len(kinds) + 1, np.int32), 0, self.start
        path[0] = state
        for i, kind in enumerate(kinds, 1):
            state, more = self.step(state, kind)
            path[i], total = state, total + more
        last = self.vectors[state]
        best = min(last[q] for q in _FINAL)
        masks = np.empty(len(path), np.uint8)
        mask = self._inserted(last, sum(1 << q for q in _FINAL if last[q] == best))
        for i in range(len(kinds), 0, -1):
            masks[i] = mask
            mask = self.behind(int(path[i - 1]), kinds[i - 1], mask)
        masks[0] = mask
        audit, q, finals = bytearray(), 0, [f for f in _FINAL if last[f] == best]
        for i in range(len(path)):
            vector, mask = self.vectors[path[i]], masks[i]
            while True:
                if i < len(kinds):
                    to, offset = self.step(int(path[i]), kinds[i])
                    on = [(x, t) for x, cost, t in self.arcs(q, kinds[i]) if masks[i + 1] >> t & 1 and vector[q] + cost == self.vectors[to][t] + offset]
                elif q in finals:
                    break
                else:
                    on = []
                t = _AFTER[q]
                insert = mask >> t & 1 and vector[q] + INSERT == vector[t]
                if insert and not (on and on[0][0] < "I"):
                    audit += b"I"
                    q = t
                    continue
                audit += on[0][0].encode()
                q = on[0][1]
                break
        return total + best, audit.decode()


def damaged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with faults: dropped, emptied, without stops, repeated or from the user, by a hash of conversation and turn."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), fault.alias("__fault")).where("__fault <> 0")
    rows = rows.withColumn("text", F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("__fault") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("__copy", F.explode(F.when(F.col("__fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("__fault", "__copy")


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, kind): turns that repeat in full as one row of n, and the kind of the first of them."""
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANK)), F.lit(1))
    small = rows.select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), (last == "").alias("blank"), last.isin(".", "!", "?").alias("ended"))
    once = checkpointed(small.groupBy("conv_id", "turn", "role", "digest").agg(F.first("blank").alias("blank"), F.first("ended").alias("ended"), F.count("*").alias("n")))
    said = once.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("m"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")).where("m > 1")
    # Written, so that both sides of the join are plain shuffles, of which a hot partition can be split.
    said = checkpointed(said.select(F.col("conv_id").alias("__c"), F.col("role").alias("__r"), F.col("digest").alias("__d"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r")) & (F.col("digest") == F.col("__d"))
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("blank"), _BLANK).when(seen, _DUPLICATE).when(~F.col("ended"), _TRUNCATED).otherwise(0)
    return checkpointed(once.join(said, same, "left").select("conv_id", "turn", "role", "digest", "n", (code + fault).cast("int").alias("kind")))


def _counts(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) from rows of _faults."""
    has = lambda bit: F.col("kind").bitwiseAND(F.lit(bit)) > 0
    again = F.col("n") - F.when(has(_BLANK) | has(_DUPLICATE), 0).otherwise(1)  # the others of equal turns
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(has(_BLANK), F.col("n")).otherwise(0)).alias("blank"), F.sum(F.when(has(_BLANK), 0).otherwise(again)).alias("duplicate"), F.count_if(has(_TRUNCATED)).alias("truncated")
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return by_turn.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")))


def _packed(rows: DataFrame) -> DataFrame:
    """(conv_id, part, at, kinds): turns in order, a byte each; a conversation is one string, or several in order of part and at."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            n, kind = batch.column("n").to_numpy(), batch.column("kind").to_numpy().astype(np.uint8)
            kinds = np.repeat(kind, n)
            # Of equal turns those after the first are duplicates, or blank like it.
            first = np.cumsum(n) - n
            again = np.ones(len(kinds), bool)
            again[first] = False
            kinds = np.where(again & (kinds < _BLANK), kinds & 3 | _DUPLICATE, kinds).astype(np.uint8)
            runs = pc.run_end_encode(batch.column("conv_id"))
            ends = np.append(first, len(kinds))[runs.run_ends.to_numpy()]
            starts = np.append(0, ends[:-1])
            own = [kinds[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            part = pa.array(np.full(len(own), batch.column("part")[0].as_py()), pa.int32())
            yield pa.RecordBatch.from_arrays([runs.values, part, pa.array(np.full(len(own), at), pa.int64()), pa.array(own, pa.binary())], names=["conv_id", "part", "at", "kinds"])

    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order).select("conv_id", F.spark_partition_id().alias("part"), "n", "kind")
    return dealt.mapInArrow(pack, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, part int, at long, kinds binary")


def _audits(packed: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) of the conversations' strings."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()

        def done(ids: list, strings: list[bytes]) -> pa.RecordBatch:
            found = [repairer.repair(x) for x in strings]
            said = [np.frombuffer(x, np.uint8) & 3 for x in strings]
            illegal = [int((~legal[x[:-1], x[1:]]).sum()) for x in said]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(illegal, pa.int64()), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], names=["conv_id", "illegal", "cost", "audit"])

        legal = np.zeros((4, 4), bool)
        legal[tuple(np.array(_LEGAL).T)] = True
        open_: list[bytes] = []
        id_ = kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            ids, strings = [], []
            for c, x in zip(batch.column("conv_id").to_pylist(), batch.column("kinds").to_pylist(), strict=True):
                if open_ and c != id_:
                    ids.append(id_)
                    strings.append(b"".join(open_))
                    open_ = []
                id_ = c
                open_.append(x)
            yield done(ids, strings)
        if open_:
            yield done([id_], [b"".join(open_)])

    dealt = packed.repartition(shuffle_partitions(packed.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "at").select("conv_id", "kinds")
    return dealt.mapInArrow(repair, f"conv_id {packed.schema['conv_id'].dataType.simpleString()}, illegal long, cost long, audit string")


class _Said:
    """The repaired conversation, hashed turn by turn as its audit tells."""

    def __init__(self, audit: str):
        self.audit, self.at, self.q, self.lines, self.hash = audit, 0, 0, 0, hashlib.sha256()

    def _say(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say(_ROLE[self.q], "")
            self.q, self.at = _AFTER[self.q], self.at + 1

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._say(role, text)
            self.q = _NEXT[role[0]][self.q]
        elif letter == "R":
            self._say(_ROLE[self.q], text)
            self.q = _AFTER[self.q]


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conv_id of turns; rows: (conv_id, turn, role, text), the turns to repair."""
    faults = _faults(rows)
    found = [turns.select("conv_id"), _counts(faults), _audits(_packed(faults))]
    every = [c.select("conv_id", *(F.col(x) if x in c.columns else F.lit(None).cast("string" if x == "audit" else "long").alias(x) for x in (*_COUNTS, "audit"))) for c in found]
    zero = F.lit(0).cast("long")
    heads = every[0].union(every[1]).union(every[2]).groupBy("conv_id").agg(*(F.coalesce(F.max(x), zero).alias(x) for x in _COUNTS), F.coalesce(F.max("audit"), F.lit("")).alias("audit"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    heads = heads.select("conv_id", F.lit(0).alias("tag"), none("long", "turn"), none("string", "role"), none("string", "text"), none("binary", "digest"), *_COUNTS, "audit")
    said = rows.select("conv_id", F.lit(1).alias("tag"), "turn", "role", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), *(none("long", x) for x in _COUNTS), none("string", "audit"))
    dealt = heads.union(said).repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "tag", F.asc_nulls_first("turn"), "role", "digest").drop("turn", "digest")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: list | None = None
        now = kind = None
        names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

        def done(rows: list) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        def closed() -> list:
            now.inserted()
            return [*head, now.hash.hexdigest()]

        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            at = np.flatnonzero(batch.column("tag").to_numpy() == 0).tolist()
            heads = batch.select(["conv_id", *_COUNTS, "audit"]).take(pa.array(at, pa.int64())).to_pylist()
            begins = dict(zip(at, heads, strict=True))
            for i, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if i in begins:
                    if head is not None:
                        out.append(closed())
                    head = list(begins[i].values())
                    now = _Said(head[-1])
                else:
                    now.turn(role, text)
            yield done(out)
        if head is not None:
            yield done([closed()])

    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{x} long" for x in _COUNTS) + ", audit string, repaired_sha256 string"
    return dealt.mapInArrow(hashed, schema)


def report(turns: DataFrame) -> DataFrame:
    """Conversations damaged by a hash of conversation and turn, and repaired."""
    return repaired(turns, damaged(turns))
