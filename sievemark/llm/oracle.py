"""DuckDB SQL of the queries that SQL can express on whole tables.

Packing, toxicity, suffix dedup, pseudo-likelihood, language and surrogates have
none: tests hold them against brute force, held-out labels or round trips.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _fold(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

_DECONTAMINATION = f"""with d as (select doc_id, regexp_extract_all({_fold("coalesce(text, '')")}, {_ALNUM}) as w from documents),
 i as (select cast(item_id as varchar) as item_id, regexp_extract_all({_fold("coalesce(text, '')")}, {_ALNUM}) as w from benchmark),
 iw as (select distinct item_id, n, array_to_string(w[a : a + n - 1], ' ') as said from (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as a from i where len(w) > 0)),
 sizes as (select distinct n from iw),
 dw as (select doc_id, n, a, array_to_string(w[a : a + n - 1], ' ') as said from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as a from d, sizes where len(w) >= n)),
 hits as (select distinct doc_id, a, dw.n, item_id from dw join iw on dw.said = iw.said and dw.n = iw.n),
 marked as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(a, a + n)) as word from hits) group by doc_id),
 named as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hits group by doc_id)
 select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join marked using (doc_id) left join named using (doc_id)"""

_JACCARD = f"""with recursive w as (select doc_id, regexp_extract_all({_fold("coalesce(text, '')")}, {_WORD}) as w from documents),
 s as (select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
 e as (select doc_id, unnest(s) as x from s), n as (select doc_id, len(s) as n from s),
 o as (select a.doc_id as a, b.doc_id as b, count(*) as o from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by all),
 l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 90 * (x.n + y.n - o)),
 sym as (select a, b from l union all select b, a from l),
 reach as (select doc_id as node, doc_id as root from n union select sym.b, reach.root from reach join sym on sym.a = reach.node)
 select n.doc_id, n.n as n_shingles, min(root) as component_id from n join reach on node = n.doc_id group by n.doc_id, n.n"""

_LINES = f"""with l as (select doc_id, unnest(s) as line, generate_subscripts(s, 1) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents)),
 k as (select *, {_fold(f"trim(line, {_BLANKS})")} as key from l),
 bad as (select key, max(doc_id) as keep from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
 m as (select k.*, bad.key is not null and doc_id <> keep as gone from k left join bad using (key))
 select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from m group by doc_id"""

_QUALITY = f"""with d as (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_WORD}) as w from documents),
 g as (select doc_id, i, array_to_string(w[i : i + 2], ' ') as x from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
 r as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as p from (select doc_id, i, count(*) over (partition by doc_id, x) as c from g) where c > 1) group by doc_id),
 l as (select doc_id, source, unnest(string_split(text, chr(10))) as line from d),
 dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from l where trim(line, {_BLANKS}) <> '' group by doc_id),
 k as (select doc_id, source, regexp_replace(lower(trim(line, {_BLANKS})), '[0-9]+', '0', 'g') as key, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) as chars from l),
 h as (select source, count(distinct doc_id) as n_host from d group by source),
 f as (select source, key from (select source, key, count(distinct doc_id) as n from k where key <> '' group by source, key having count(distinct doc_id) >= 20) join h using (source) where n * 100 >= n_host),
 gone as (select doc_id, count(*) as n_frequent_lines, sum(chars) as frequent_chars from k join f using (source, key) group by doc_id),
 base as (select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols from d),
 joined as (select base.*, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_frequent_lines, 0) as n_frequent_lines, cast(coalesce(frequent_chars, 0) as bigint) as frequent_chars from base left join dup using (doc_id) left join r using (doc_id) left join gone using (doc_id)),
 v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from joined)
 select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not frequent_chars * 100 > word_chars * 50 as kept, n_frequent_lines, frequent_chars from v"""

_FINITE = "embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))"


def _scaled(scale: int) -> str:
    return f"list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint))"


_TOP = f"""with v as (select row_number() over () as r, vec_id, {_scaled(256)} as v from embeddings where coalesce({_FINITE}, len(embedding) = 0)),
 s as (select q.r, q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) as score from v q join v c on q.vec_id % 50 = 0 and q.r <> c.r)
 select query_id, rank, vec_id, cast(score as bigint) as score from (select *, cast(row_number() over (partition by r order by score desc, vec_id nulls last) as integer) as rank from s) where rank <= 5"""


def _k_means(k: int = 8, rounds: int = 10) -> str:
    """Assignments and centroids of every round as tables of their own."""
    ctes = [f"v as materialized (select row_number() over () as r, vec_id, {_scaled(1024)} as v from embeddings where len(embedding) = 64 and {_FINITE})"]
    ctes += [f"c0 as materialized (select cast(row_number() over (order by sha256('3:' || vec_id), v) - 1 as integer) as j, v as c from v where vec_id is not null order by sha256('3:' || vec_id), v limit {k})"]
    square = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    for t in range(rounds + 1):
        ctes += [f"a{t} as materialized (select r, min([d, j]) as n from (select r, j, cast({square} as bigint) as d from v, c{t}) group by r)"]
        if t < rounds:
            ctes += [
                f"m{t} as materialized (select j, list(cast(((s - ((s % n) + n) % n) // n) as bigint) order by i) as c from (select n[2] as j, i, sum(x) as s, count(*) as n from (select r, unnest(v) as x, unnest(range(1, 65)) as i from v) join a{t} using (r) group by all) group by j)",
                f"c{t + 1} as materialized (select c{t}.j, coalesce(m{t}.c, c{t}.c) as c from c{t} left join m{t} using (j))",
            ]
    t = rounds
    return "with " + ",\n ".join(ctes) + f"""
 select vec_id, cast(n[2] as integer) as cluster, n[1] as distance, cast(sum(n[1]) over (partition by n[2]) as bigint) as cluster_inertia, cast(sum(n[1]) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
 from a{t} join v using (r) join c{t} on c{t}.j = n[2]"""


#: Edits of a turn in each state (0 nothing said, 1 after s, 2 after u, 3 after a): letter, cost, state after it, role given.
_EDITS = "select * from (values (0, 'D', 3, 0, ''), (1, 'D', 3, 1, ''), (2, 'D', 3, 2, ''), (3, 'D', 3, 3, ''), (0, 'Ks', 0, 1, ''), (0, 'Ku', 0, 2, ''), (1, 'Ku', 0, 2, ''), (2, 'Ka', 0, 3, ''), (3, 'Ku', 0, 2, ''), (0, 'R', 2, 2, 'user'), (1, 'R', 2, 2, 'user'), (2, 'R', 2, 3, 'assistant'), (3, 'R', 2, 2, 'user')) t(q, letter, cost, q2, name)"
#: What is inserted after an edit, if anything.
_INSERTS = "select * from (values (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (2, 3, 'I', 2, ['assistant:']), (3, 2, 'I', 2, ['user:']), (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 3, 'II', 4, ['user:', 'assistant:'])) t(q2, q3, said, more, lines)"

_REPAIR = f"""with recursive crc as materialized (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, y: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
 c as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, list_concat([4294967295], list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ord(x) as bigint))) as bytes from conversations),
 h as (select conv_id, turn, role, text, xor(list_reduce(bytes, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 as fault from c, crc),
 e as (select conv_id, turn, case when fault = 4 then 'user' else role end as role, case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text from h, range(2) copies(copy) where fault <> 0 and (copy = 0 or fault = 3)),
 o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i, rtrim(text, {_BLANKS}) as said from e),
 f as materialized (select conv_id, turn, i, role, text, said = '' as blank, said <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate, right(said, 1) not in ('.', '!', '?') as cut from o),
 k as (select *, cut and not blank and not duplicate as truncated, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as prior from f),
 n as (select conv_id, count(*) as n, count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated, count(*) filter (prior is not null and prior || initial not in ('su', 'ua', 'au')) as illegal, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps from k group by conv_id),
 edits as materialized ({_EDITS}), inserts as materialized ({_INSERTS}),
 every as (select distinct conv_id from conversations),
 steps as (
  select conv_id, 0 as i, q3 as q, lpad(cast(more as varchar), 12, '0') || said as key, lines from every, inserts where q2 = 0
  union all
  select conv_id, i, q, min(key) as key, arg_min(lines, key) as lines from (
   select s.conv_id, s.i + 1 as i, q3 as q, lpad(cast(cast(left(s.key, 12) as bigint) + edits.cost + more + case when k.truncated and letter <> 'D' then 1 else 0 end as varchar), 12, '0') || substr(s.key, 13) || left(letter, 1) || inserts.said as key,
    list_concat(s.lines, case when letter = 'D' then [] when letter = 'R' then [name || ':' || k.text] else [role || ':' || k.text] end, inserts.lines) as lines
   from steps s join k on s.conv_id is not distinct from k.conv_id and k.i = s.i + 1 join edits on edits.q = s.q join inserts on inserts.q2 = edits.q2
   where letter in ('D', 'R', 'K' || initial) and (letter = 'D' or not (k.blank or k.duplicate))) group by conv_id, i, q)
 select every.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(left(min(key), 12) as bigint) as cost, substr(min(key), 13) as audit, sha256(array_to_string(arg_min(lines, key), chr(10))) as repaired_sha256
 from every left join n on n.conv_id is not distinct from every.conv_id join steps on steps.conv_id is not distinct from every.conv_id and steps.i = coalesce(n.n, 0) and q in (0, 3) group by all"""


SQL: dict[str, str] = {
    "op2_prefix_decontamination": _DECONTAMINATION,
    "op5_ngram_jaccard": _JACCARD,
    "op6_line_dedup": _LINES,
    "op8_line_frequency": _QUALITY,
    "op11_maxscore_topk": _TOP,
    "op12_yinyang_clusters": _k_means(),
    "op13_conversation_repair": _REPAIR,
}
