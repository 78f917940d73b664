"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations


def _nodes(name: str, below: str) -> str:
    """A level's nodes with their digests to the left and right in their run; ``size`` 1 is a finished tree."""
    run = "over (partition by k, i // 8 order by i rows between unbounded preceding and 1 preceding)"
    after = "over (partition by k, i // 8 order by i rows between 1 following and unbounded following)"
    return f"""{name} as materialized (select k, i, h, count(*) over (partition by k) as size,
      coalesce(string_agg(h, '') {run}, '') as l, coalesce(string_agg(h, '') {after}, '') as r from {below})"""


def _above(nodes: str) -> str:
    return f"(select k, i // 8 as i, case when max(size) = 1 then max(h) else sha256(string_agg(h, '' order by i)) end as h from {nodes} group by k, i // 8)"


def _folded(name: str, before: str, nodes: str, place: str, key: str = "k") -> str:
    return f"""{name} as (select f.* replace (case when n.size = 1 then f.acc else sha256(n.l || f.acc || n.r) end as acc,
      f.proof || n.l || n.r as proof) from {before} f join {nodes} n on n.k = {key} and n.i = {place})"""


def _merkle(levels: int = 8, top: int = 3) -> str:
    """Levels beyond a tree's own height change nothing; eight levels hold 8^8 leaves of a language."""
    field = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::bigint],
      list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
        lambda c, k: xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end))))"""
    parts = [
        f"""leaves as materialized (select doc_id, lang, coalesce('1' || lang, '0') as k, {leaf('text')} as leaf,
      case when {crc} % 3 = 0 then {leaf(lowered)} else {leaf('text')} end as changed from documents)""",
        """placed as materialized (select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as place from leaves)""",
        _nodes("n0", "(select k, place as i, leaf as h from placed)"),
    ]
    parts += [_nodes(f"n{j}", _above(f"n{j - 1}")) for j in range(1, levels)]
    parts.append(f"subroots as materialized (select k, h as subroot, row_number() over (order by k) - 1 as spot from {_above(f'n{levels - 1}')})")
    parts.append(_nodes("t0", "(select '' as k, spot as i, subroot as h from subroots)"))
    parts += [_nodes(f"t{j}", _above(f"t{j - 1}")) for j in range(1, top)]
    parts.append(f"whole as (select h as root from {_above(f't{top - 1}')})")
    parts.append("f0 as (select p.*, s.subroot, s.spot, changed as acc, '' as proof from placed p join subroots s on s.k = p.k)")
    parts += [_folded(f"f{j + 1}", f"f{j}", f"n{j}", f"f.place // {8**j}", "f.k") for j in range(levels)]
    parts += [_folded(f"f{levels + j + 1}", f"f{levels + j}", f"t{j}", f"f.spot // {8**j}", "''") for j in range(top)]
    return "with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, acc as folded_root, acc = root as verified, lang, place
from f{levels + top}, whole"""


MERKLE = _merkle()

NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other, cast(list_dot_product(a.x, b.x) as bigint) as score
  from (select * from rows where vec_id % 100 = 0) a join rows b on a.vec_id <> b.vec_id
), positives as (
  select anchor_id, other as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
)
select anchor_id, positive_id, cast(row_number() over w as integer) as rank, other as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other)
qualify row_number() over w <= 10
"""


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _runs(words: str, width: int) -> str:
    """All runs of ``width`` words, in order; words hold no blank, so a blank joins them reversibly."""
    return f"list_transform(range(1, len({words}) - {width - 2}), lambda i: array_to_string({words}[i:i + {width - 1}], ' '))"


# The smallest id reachable over links (a, b), which hold both directions.
_REACHED = """reached(a, b) as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
smallest as (select a, min(b) as c from reached group by a)"""

NEAR_VECTORS = f"""
with recursive v as materialized (
  select row_number() over () as r, vec_id, label, embedding::double[] as x from embeddings
), good as materialized (
  select * from v where vec_id is not null and label is not null and x is not null
    and len(list_filter(x, lambda e: e is null or not isfinite(e))) = 0 and len(list_filter(x, lambda e: e <> 0)) > 0
), pairs as materialized (
  select p.r, p.vec_id as a, q.vec_id as b from good p join good q on p.label = q.label and p.r <> q.r
  where len(p.x) = len(q.x) and list_cosine_similarity(p.x, q.x) >= 0.98
), links as materialized (select distinct a, b from pairs),
{_REACHED}
select vec_id, (select count(*) from pairs where pairs.r = v.r) as n_links, least(vec_id, coalesce(c, vec_id)) as component_id,
  vec_id = least(vec_id, coalesce(c, vec_id)) as kept
from v left join smallest on a = vec_id
"""

REPEATED_SPANS = f"""
with d as materialized (select doc_id, {_words('text')} as w from documents),
runs as materialized (
  select doc_id, unnest({_runs('w', 13)}) as s, unnest(range(1, len(w) - 11)) as i from d
), firsts as (select s, min(doc_id) as f from runs group by s),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as i from runs join firsts using (s) where f < doc_id
), word as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from d),
kept as (select doc_id, count(*) as n, string_agg(x, ' ' order by i) as t from word anti join gone using (doc_id, i) group by doc_id)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""

NEAR_DOCUMENTS = f"""
with recursive d as materialized (
  select doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents
), sets as materialized (
  select doc_id, list_distinct(case when len(w) between 1 and 4 then [array_to_string(w, ' ')] else {_runs('w', 5)} end) as s from d
), each_one as materialized (select doc_id, len(s) as n, unnest(s) as s from sets),
links as materialized (
  select p.doc_id as a, q.doc_id as b from each_one p join each_one q on p.s = q.s and p.doc_id <> q.doc_id
  group by p.doc_id, q.doc_id, p.n, q.n having 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
{_REACHED}
select doc_id, len(s) as n_shingles, least(doc_id, coalesce(c, doc_id)) as component_id,
  doc_id = least(doc_id, coalesce(c, doc_id)) as kept
from sets left join smallest on a = doc_id
"""

# Counts of one text, then lines of more than 5 % of a host's distinct texts and more than 20 of them.
LINE_QUALITY = rf"""
with d as materialized (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t, {_words('text')} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
), runs as materialized (select r, unnest({_runs('w', 5)}) as s, unnest(range(1, len(w) - 3)) as i from d),
again as (select r, s from runs group by r, s having count(*) > 1),
covered as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 5)) as p from runs semi join again using (r, s)) group by r),
judged as materialized (
  select d.r, doc_id, source, t, l, len(w) as n_words, cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
    len(w) < 10 or 100 * coalesce(n, 0) > 20 * len(w) as base_failed
  from d left join covered using (r)
), line as materialized (
  select r, doc_id, source, t, trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as s,
    len({_words('x')}) as n
  from (select r, doc_id, source, t, unnest(l) as x from judged)
), hosts as (select source, count(distinct t) as docs from judged group by source),
often as (
  select c.source, s, first_doc
  from (select source, s, count(distinct t) as n, min(doc_id) as first_doc from line group by source, s) c
    join hosts h on c.source is not distinct from h.source
  where n > 20 and n > cast(0.05 as double) * docs
), lost as (
  select r, cast(sum(n) as bigint) as n from line join often
    on line.source is not distinct from often.source and line.s = often.s and line.doc_id is distinct from first_doc
  group by r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (coalesce(n, 0) > 0 and n_words - coalesce(n, 0) <= cast(0.1 as double) * n_words) as kept,
  coalesce(n, 0) as n_removed_words
from judged left join lost using (r)
"""
