"""DuckDB SQL for those queries of this folder that it can state."""

from __future__ import annotations

from ledgerweave.llm.heap_clusters import CLUSTERS, ROUNDS, SCALE, SEED, SIZE
from ledgerweave.llm.repeated_spans import LENGTH

LOWERED = (
    "translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

LEXICAL = rf"""
    with words as (
        select row_number() over () as row, doc_id,
               regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
        from documents
    ), counted as (
        select row, doc_id, len(w) as n, unnest(w) as term from words
    ), tf as (
        select row, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*) as tf
        from counted group by row, term
    ), corpus as (
        select count(*) filter (len(w) > 0) as docs, sum(len(w))::bigint as terms from words
    ), df as (
        select term, count(*) as df from tf group by term
    ), asked as (
        select item_id, unnest(
            regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
        ) as term
        from benchmark
    ), wanted as (
        select item_id, term, count(*) as times from asked group by item_id, term
    ), gains as (
        select item_id, row, doc_id,
               times * floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint
               * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))
                   as gain
        from wanted join df using (term) join tf using (term), corpus
    ), scores as (
        select item_id, row, any_value(doc_id) as doc_id, sum(gain)::bigint as score
        from gains group by item_id, row having sum(gain) > 0
    )
    select item_id,
           row_number() over (partition by item_id order by score desc, doc_id nulls last)::int
               as rank,
           doc_id, score
    from scores
    qualify rank <= 10
"""


def _means() -> str:
    """The rounds of the clustering, each an assignment and new means."""
    parts = [
        f"""
        kept as materialized (
            select vec_id, label,
                   list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v,
                   row_number() over (order by sha256('{SEED}:' || vec_id) nulls last) - 1 as row
            from embeddings
            where len(embedding) = {SIZE}
              and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {SIZE}
        ), c0 as materialized (
            select row as c, v from kept where row < {CLUSTERS} and vec_id is not null
        )"""
    ]
    for r in range(ROUNDS + 1):
        # The distance and the number in one integer, so that ties go to the smaller number.
        parts.append(
            f"""
        a{r} as materialized (
            select row, min(64 * list_sum(list_transform(
                       list_zip(kept.v, c{r}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])
                   ))::bigint + c) as near
            from kept, c{r} group by row
        )"""
        )
        if r < ROUNDS:
            parts.append(
                f"""
        m{r} as (
            select near % 64 as c, place, sum(x)::bigint as s, count(*) as n
            from (
                select near, unnest(v) as x, unnest(range({SIZE})) as place
                from a{r} join kept using (row)
            )
            group by near % 64, place
        ), c{r + 1} as materialized (
            select c{r}.c, coalesce(any_value(means.v), any_value(c{r}.v)) as v
            from c{r} left join (
                select c, list((s - ((s % n) + n) % n) // n order by place) as v
                from m{r} group by c
            ) as means using (c)
            group by c{r}.c
        )"""
            )
    return f"""
    with {", ".join(parts)}
    select vec_id, (near % 64)::int as cluster, near // 64 as distance,
           sum(near // 64) over (partition by near % 64)::bigint as cluster_inertia,
           sum(near // 64) over ()::bigint as inertia,
           sha256(array_to_string(c{ROUNDS}.v, ',')) as centroid_sha256
    from a{ROUNDS} join kept using (row) join c{ROUNDS} on c = near % 64
    """


MEANS = _means()

REPEATS = f"""
    with texts as materialized (
        select row_number() over () as row, doc_id, encode(coalesce(text, '')) as b
        from documents
    ), windows as (
        select row, i, sha256(b[i + 1:i + {LENGTH}]) as mark
        from (
            select row, b, unnest(range(0, greatest(octet_length(b) - {LENGTH} + 1, 0))) as i
            from texts
        )
    ), marks as (
        select mark from windows group by mark having count(*) > 1
    ), found as (
        select row, i from windows where mark in (select mark from marks)
    ), opened as (
        select row, i, case when i > lag(i) over (partition by row order by i) + {LENGTH}
                              or lag(i) over (partition by row order by i) is null
                       then 1 else 0 end as opens
        from found
    ), numbered as (
        select row, i, sum(opens) over (partition by row order by i) as span from opened
    ), spans as (
        select row, span, min(i) as a, max(i) + {LENGTH} as z from numbered group by row, span
    ), kept as (
        select row, span, lag(z, 1, 0) over (partition by row order by span) as a, a as z
        from spans
        union all
        select row, 1000000000, max(z), null from spans group by row
    ), pieces as (
        select row, string_agg(hex(b[a + 1:coalesce(z, octet_length(b))]), '' order by span) as rest
        from kept join texts using (row) group by row
    ), sums as (
        select row, sum(z - a)::bigint as n_removed, count(*) as n_spans from spans group by row
    )
    select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed,
           coalesce(n_spans, 0) as n_spans, sha256(coalesce(unhex(rest), b)) as kept_sha256
    from texts left join sums using (row) left join pieces using (row)
"""


_CLOSURE = """
    reach(a, b) as (
        select id, id from nodes
        union
        select reach.a, links.b from reach join links on reach.b = links.a
    ), classes as (
        select a as id, min(b) as class from reach group by a
    ), counts as (
        select a as id, count(*) as n from links group by a
    )
"""

NGRAMS = rf"""
    with recursive words as (
        select doc_id as id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') as w
        from documents
    ), shingles as (
        select distinct id, array_to_string(w[i:i + 4], ' ') as shingle
        from (select id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i
              from words)
    ), sizes as (
        select id, count(*) as size from shingles group by id
    ), shared as (
        select a.id as a, b.id as b, count(*) as common
        from shingles a join shingles b on a.shingle = b.shingle and a.id <> b.id
        group by a.id, b.id
    ), links as materialized (
        select a, b from shared join sizes x on x.id = a join sizes y on y.id = b
        where 10 * common >= 8 * (x.size + y.size - common)
    ), nodes as (
        select id from words
    ), {_CLOSURE}
    select words.id as doc_id, class as class_id, coalesce(n, 0) as n_links,
           words.id = class as kept
    from words join classes using (id) left join counts using (id)
"""

VECTORS = f"""
    with recursive usable as (
        select vec_id as id, embedding::double[] as v
        from embeddings
        where len(embedding) > 0
          and len(list_filter(embedding, lambda x: x is not null and isfinite(x)))
              = len(embedding)
          and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as materialized (
        select a.id as a, b.id as b
        from usable a join usable b on a.id <> b.id and len(a.v) = len(b.v)
        where list_cosine_similarity(a.v, b.v) >= 0.9
    ), nodes as (
        select vec_id as id from embeddings
    ), {_CLOSURE}
    select nodes.id as vec_id, coalesce(n, 0) as n_links, class as component_id,
           nodes.id = class as kept
    from nodes join classes using (id) left join counts using (id)
"""
