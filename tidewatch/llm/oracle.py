"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import merkle, mixing, secrets, trie


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind_sql(kind: str) -> str:
    """Spans of one kind: running lengths of the texts between matches and of the matches."""
    k, pattern = secrets.KINDS.index(kind), _quoted(secrets.PATTERNS[kind])
    value = f"regexp_extract(m, {_quoted(secrets.ASSIGN_VALUE)}, 1)" if kind == "assign" else "m"
    least = secrets.MIN_ASSIGN_VALUE if kind == "assign" else 0
    return f"""
      select row, doc_id, source, lang, {k} as kind, a, a + length(m) as b, sha256(v) as hash from (
        select *, {value} as v, list_sum(list_transform(p[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) as a
        from (select row, doc_id, source, lang, p, f, f[i] as m, i from (
          select row, doc_id, source, lang, string_split_regex(text, {pattern}) as p,
                 regexp_extract_all(text, {pattern}) as f, unnest(range(1, len(f) + 1)) as i from docs))
      ) where length(v) >= {least}"""


def _secret_sql() -> str:
    cred = secrets.KINDS.index(secrets.ADDED_KIND)
    names = ", ".join(f"'{k}'" for k in secrets.KINDS)
    base = f"coalesce(string_agg(([{names}])[kind + 1] || ':' || a || ':' || b, ',' order by a, kind) filter (kind < {cred}), '')"
    counts = ", ".join(f"count(kind) filter (kind = {i})::bigint as n_{k}" for i, k in enumerate(secrets.BASE_KINDS))
    return f"""
    with docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text, source, lang from documents),
    spans as ({" union all ".join(_kind_sql(k) for k in secrets.KINDS)}),
    owned as (select hash, count(distinct coalesce(source, '')) as n_owners,
                     count(distinct (coalesce(source, ''), coalesce(lang, ''))) as n_repos from spans group by hash),
    met as (select s.*, n_owners, n_repos, n_owners <= {secrets.MAX_LIVE_OWNERS}
                   and n_repos <= {secrets.MAX_LIVE_REPOS} as live from spans s join owned using (hash))
    select d.doc_id, {counts}, sha256({base}) as base_sha256,
           coalesce(string_agg(([{names}])[kind + 1] || ':' || a || ':' || b, ',' order by a, kind)
                    filter (kind < {cred} or live), '') as spans,
           coalesce(max(n_owners), 0)::bigint as n_owners, coalesce(max(n_repos), 0)::bigint as n_repos,
           count(kind) filter (live)::bigint as n_live
    from docs d left join met k on k.row = d.row group by d.row, d.doc_id"""


def _mix_sql() -> str:
    """The exponent by trying the whole grid, then quotas, blocks and cuts."""
    g, seed = mixing.GRID, mixing.SEED

    def h(*parts: str) -> str:
        return f"md5('{seed}|' || " + " || '|' || ".join(f"coalesce({p}::varchar, '')" for p in parts) + ")"

    return f"""
    with sized as (select doc_id, coalesce('=' || source, '') as source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens, md5(coalesce(text, '')) as hash from documents),
    sums as (select source, count(*) as n_docs, sum(n_tokens)::bigint as tokens from sized group by source),
    shares as (select *, sum(tokens) over ()::bigint as total,
        case when sum(tokens) over () > 0 then tokens / sum(tokens) over ()::double else 0 end as p from sums),
    tries as (select a, count(*) as s, sum(pow(p, a / {g}.0::double)) as z,
        sum(pow(p, a / {g}.0::double) * ln(p)) as l, max(pow(p, a / {g}.0::double) / p) as m
        from shares, range(0, {g} + 1) t(a) where p > 0 group by a),
    pick as (select greatest(
        coalesce((select max(a) from tries where ln(z) - a / {g}.0::double * l / z >= {mixing.ENTROPY}::double * ln(s)), 0),
        coalesce((select min(a) from tries where m / z <= {mixing.MAX_REPEATS}::double), {g})) / {g}.0::double as a),
    weighted as (select s.*, pow(p, a) / sum(case when p > 0 then pow(p, a) else 0 end) over () as weight from shares s, pick),
    plan as (select *, floor(total * case when p > 0 then weight else 0 end)::bigint as quota from weighted),
    parts as (select *, case when tokens > 0 then quota // tokens else 0 end as whole,
        quota - (case when tokens > 0 then quota // tokens else 0 end) * tokens as rest from plan),
    dealt as (select d.*, (('0x' || substr({h("'block'", "doc_id", "hash")}, 1, 12))::bigint % ceil(sqrt(n_docs))::bigint) as block,
        whole, rest from sized d join parts using (source)),
    blocks as (select source, block, any_value(whole) as whole, any_value(rest) as rest, sum(n_tokens)::bigint as bt
        from dealt group by source, block),
    cut as (select source, block, rest - (sum(bt) over (partition by source order by {h("whole", "source", "block")}, block
        rows unbounded preceding) - bt) as left_over from blocks),
    used as (select d.*, left_over,
        row_number() over w as doc_order, sum(n_tokens) over (w rows unbounded preceding) as upto
        from dealt d join cut using (source, block)
        window w as (partition by source, block order by {h("source", "doc_id", "hash")}, doc_id, hash)),
    copies as (select *, unnest(range(0, (whole + case when upto <= left_over then 1 else 0 end)::bigint)) as epoch from used)
    select doc_id, case when source <> '' then substr(source, 2) end as source, n_tokens, epoch::int as epoch,
        block::int as block, {h("epoch", "source", "block")} as block_order, doc_order::int as doc_order from copies"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: a byte, then eight shifts, for each character."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295::bigint], {steps}), lambda a, x: case when x >= 0 then xor(a, x) "
            "else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end), 4294967295)")


def _trie_sql() -> str:
    """Every prefix of every conversation, as a list of turns; subtrees by the prefixes of nodes."""
    return f"""
    with marked as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                    where conv_id is not null),
    convs as (select conv_id, list({{'role': role, 'text': text}} order by turn nulls first,
        substr(sha256(strlen(role) || ':' || role || text), 1, 32)) as turns from marked group by conv_id),
    hs as (select *, ({_crc32("conv_id::varchar")} % {trie.HEAD})::bigint as h from convs),
    seqs as (select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as seq
        from hs o left join convs b on b.conv_id = o.conv_id - o.conv_id % {trie.SPAN}),
    members as (select conv_id, d, seq[1:d] as p, d = len(seq) as ends from (select *, unnest(range(0, len(seq) + 1)) as d from seqs)),
    nodes as (select p, d, min(conv_id) as conv_id, count(*) as n_convs,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as ids from members group by p, d),
    families as (select p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by 1),
    below as (select p[1:e] as p, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from (
        select n.p, unnest(range(0, d + 1)) as e, (f.n is null)::int as leaf,
               case when d = 0 then 0 else (n_convs - 1) * length(n.p[d].text) end as saved
        from nodes n left join families f on f.p = n.p) group by 1)
    select n.conv_id, n.d::bigint as depth, a.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
        coalesce(f.n, 0)::bigint as n_children, b.n_leaves, b.saved_tokens, sha256(n.ids) as ends_sha256
    from nodes n join below b on b.p = n.p left join families f on f.p = n.p
    left join nodes a on n.d > 0 and a.p = n.p[1:n.d - 1] and a.d = n.d - 1"""


def _merkle_sql() -> str:
    """Levels by recursion over (tree, level, position); the groups' roots are the tree '' one step above."""
    def field(c: str) -> str:
        return f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(n_chars if c == "n_chars" else c) for c in merkle.FIELDS) + ")"

    def levels(name: str, source: str) -> str:
        return f"""{name}(g, k, i, n, x) as (
        select g, 0, i, n, x from {source}
        union all
        select g, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(x, '' order by i)) from {name} where n > 1
        group by g, k, i // 2, n)"""

    def siblings(tree: str, rows: str) -> str:
        """The sibling of each row at each level, with its side."""
        return f"""(select r.row, t.k, case when t.i % 2 = 0 then 'l' else 'r' end || t.x as s
            from {rows} r join {tree} t on t.g = r.g and t.n > 1 and t.i = xor(r.i >> t.k, 1))"""

    return f"""
    with recursive leaves as (select row_number() over () as row, doc_id, coalesce('=' || lang, '') as g, {leaf("n_chars")} as leaf,
        case when {_crc32("coalesce(doc_id::varchar, '')")} % {merkle.TAMPERED} = 0 and doc_id is not null and n_chars is not null
             then {leaf("n_chars::hugeint + 1")} end as bent from documents),
    placed as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i,
        count(*) over (partition by g) as n, leaf as x from leaves),
    {levels("tree", "placed")},
    tops as (select g as name, '' as g, x, row_number() over (order by g) - 1 as i, count(*) over () as n from tree where n = 1),
    {levels("upper", "tops")},
    members as (select p.row, t.g, t.i from placed p join tops t on t.name = p.g),
    steps as (select row, k, s from {siblings("tree", "placed")} union all
        select row, 1000 + k, s from {siblings("upper", "members")}),
    every as (select p.row, k from placed p join (select distinct g, k from tree where n > 1) using (g)
        union all select m.row, 1000 + k from members m, (select distinct k from upper where n > 1)),
    paths as (select row, list(coalesce(s, '') order by k) as path from every left join steps using (row, k) group by row)
    select p.doc_id, p.leaf, t.x as subroot, u.x as root,
        sha256(coalesce(list_reduce(list_concat([''], list_transform(path, lambda s: s[2:])), lambda a, s: a || s), '')) as proof_sha256,
        list_reduce(list_concat([coalesce(bent, leaf)], coalesce(path, [])), lambda a, s:
            sha256(case when s[1] = 'l' then s[2:] else '' end || a || case when s[1] = 'r' then s[2:] else '' end)) as folded_root,
        folded_root = root as verified
    from placed p join tops t on t.name = p.g join upper u on u.n = 1 left join paths using (row)"""


ORACLES = {"op6_source_mixture": _mix_sql(), "op9_secret_scan": _secret_sql(), "op12_conversation_trie": _trie_sql(),
           "op13_merkle_manifest": _merkle_sql()}
