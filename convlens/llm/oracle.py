"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from convlens.llm import licenses

#: Bytes of a shard in the registered query: small, so that small tables have several.
SHARD_BYTES = 1 << 20
#: Hash bits that the SQL looks at; shards of the test tables are told apart by fewer.
SQL_BITS = 24


def sharding() -> str:
    """The smallest depth at which a bucket fits or is one row."""
    bucket = "over (partition by h >> (40 - {d}))"
    fits = " ".join(
        f"when sum(b) {bucket.format(d=d)} <= {SHARD_BYTES} or count(*) {bucket.format(d=d)} = 1 then {d}" for d in range(SQL_BITS + 1)
    )
    return f"""
        with sized as (
            select doc_id, coalesce(strlen(text), 0)::bigint as b,
                   ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 10))::bigint as h
            from documents
        ), deep as (select *, (case {fits} end)::bigint as d from sized)
        select doc_id, b as n_bytes, substr(right(bin(h + (1::bigint << 40)), 40), 1, d) as shard, d as shard_depth,
               (sum(b) over (partition by d, h >> (40 - d)))::bigint as shard_bytes
        from deep
    """


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spelled(text: str) -> str:
    pairs = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in licenses.SPELLINGS.items())
    words = f"string_split(regexp_replace({text}, {_quoted(licenses.BETWEEN)}, ' ', 'g'), ' ')"
    return f"trim(array_to_string(list_transform({words}, lambda w: coalesce(map {{{pairs}}}[w], w)), ' '))"


def _digest(text: str) -> str:
    bare = f"regexp_replace(lower(coalesce({text}, '')), {_quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
    form = _spelled(bare)
    return f"case when {form} <> '' then sha256({form}) end"


def license_scan() -> str:
    """Canonical digests of whole texts, with and without holders' lines, joined; lines that are a known notice."""
    texts = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.titled_texts())
    longer = ", ".join(f"({_quoted(k)}, {_quoted(d)})" for k, own in licenses.DIGESTS.items() for d in own)
    known = {licenses.plain_canonical(line): key for line, key in licenses.notices().items()}
    lines = ", ".join(f"({_quoted(line)}, {_quoted(key)})" for line, key in known.items())
    holder = f"regexp_matches(line, {_quoted(f'^{licenses.HOLDER}[^ \\t\\r]+([ \\t]+[^ \\t\\r]+){{0,6}}[ \\t\\r]*$')})"
    wrapped = f"regexp_matches(line, {_quoted(f'^{licenses.HOLDER}{licenses.NO_HOLDER}')})"
    bare = f"array_to_string(list_filter(string_split(lower(coalesce(text, '')), chr(10)), lambda line: not ({holder} and not {wrapped})), chr(10))"
    return f"""
        with known as (
            select digest, min(license) as license from (
                select license, {_digest("text")} as digest from (values {texts}) t(license, text)
                union all select license, digest from (values {longer}) t(license, digest)
            ) group by digest
        ), notice(line, license) as (values {lines}),
        line as (
            select doc_id, unnest(string_split(lower(coalesce(text, '')), chr(10))) as line from documents
        ), named as (
            select doc_id, array_to_string(list_sort(list(distinct n.license)), ',') as notices
            from (select doc_id, {_spelled("line")} as line from line) l join notice n using (line) group by doc_id
        ), marked as (select doc_id, {_digest("text")} as digest, {_digest(bare)} as bare from documents)
        select m.doc_id, m.digest, coalesce(k.license, b.license) as license, coalesce(n.notices, '') as notices
        from marked m left join known k using (digest) left join known b on b.digest = m.bare left join named n using (doc_id)
    """


def prefix_trie() -> str:
    """Every prefix as a list of turn names; subtrees by comparing prefixes; CRC-32 by its table."""
    bit = "(case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)"
    step = "lambda s, b: xor(s // 256, coded[xor(s % 256, b) + 1])"
    crc = f"xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint), {step}, 4294967295::bigint), 4294967295)"
    return f"""
        with recursive crc as (
            select i::bigint as i, 0 as k, i::bigint as x from range(256) r(i) union all select i, k + 1, {bit} from crc where k < 8
        ), codes as (select list(x order by i) as coded from crc where k = 8),
        named as (
            select conv_id, turn, strlen(coalesce(text, ''))::bigint as n,
                   md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id
            from conversations where conv_id is not null
        ), lists as (
            select conv_id, list({{'id': id, 'n': n}} order by turn nulls first, id) as turns from named group by conv_id
        ), own as (select conv_id, turns, {crc} % 9 as h from lists, codes),
        whole as (
            select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
            from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 5
        ), member as (
            select conv_id, d, list_transform(turns[1:d], lambda t: t.id) as path, len(turns) as size, coalesce(turns[d].n, 0) as n
            from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from whole)
        ), node as (
            select path, min(conv_id) as conv_id, d, count(*) as n_convs, max(n) as n,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = d), '')) as ends_sha256
            from member group by path, d
        ), kid as (
            select p.path, count(k.path) as n_children from node p left join node k on k.d = p.d + 1 and k.path[1:p.d] = p.path group by p.path
        ), below as (
            select p.path, sum((u.n_convs - 1) * u.n)::bigint as saved_tokens, count(*) filter (where kid.n_children = 0) as n_leaves
            from node p join node u on u.path[1:p.d] = p.path and u.d >= p.d join kid on kid.path = u.path group by p.path
        )
        select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, kid.n_children, below.n_leaves, below.saved_tokens, n.ends_sha256
        from node n left join node p on n.d = p.d + 1 and p.path = n.path[1:p.d]
        join kid on kid.path = n.path join below on below.path = n.path
    """


def centroids(count: int, rounds: int, seed: int) -> str:
    """Every round assigns all vectors; means are floored in whole numbers."""
    parts = [
        """kept as materialized (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
        )""",
        f"""m0 as materialized (
            select (row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), v) - 1)::integer as c, v from kept
            qualify row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), v) <= {count}
        )""",
    ]
    gap = "list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        parts.append(f"""a{r} as materialized (
            select vec_id, k.v, min_by(m.c, (d, m.c)) as c, min(d)::bigint as d
            from (select rn, vec_id, v from (select *, row_number() over () as rn from kept)) k, lateral (select m.c, {gap}::bigint as d from m{r} m) m
            group by rn, vec_id, k.v
        )""")
        if r < rounds:
            parts.append(f"""m{r + 1} as materialized (
                select m.c, coalesce(n.v, m.v) as v from m{r} m left join (
                    select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v
                    from (select c, i, sum(x)::bigint as s, count(*) as n from (select c, unnest(v) as x, generate_subscripts(v, 1) as i from a{r}) group by c, i)
                    group by c
                ) n using (c)
            )""")
    return f"""
        with {", ".join(parts)}
        select a.vec_id, a.c as cluster, a.d as distance, (sum(a.d) over (partition by a.c))::bigint as cluster_inertia,
               (sum(a.d) over ())::bigint as inertia, sha256(array_to_string(m.v, ',')) as centroid_sha256
        from a{rounds} a join m{rounds} m on m.c = a.c
    """
