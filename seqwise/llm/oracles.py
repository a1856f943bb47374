"""DuckDB SQL of the text queries that SQL can express, over the whole tables."""

from __future__ import annotations

from seqwise.llm import licenses, urls

_WORD = r"[^\x20\x09-\x0D]"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = f"""with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
    w as (select *, regexp_extract_all(t, '{_WORD}+') as ws,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls from d),
    win as (select r, i, array_to_string(ws[i:i + 7], ' ') as g from w, generate_series(1, len(ws) - 7) s(i)),
    dup as (select r, i from (select r, i, count(*) over (partition by r, g) as c from win) x where c > 1),
    rep as (select r, count(distinct i + k) as n from dup, generate_series(0, 7) s(k) group by r),
    ln as (select r, source, regexp_extract_all({_LOW.format("x")}, '{_WORD}+') as ws
           from (select r, source, unnest(ls) as x from w) u),
    nl as (select r, source, array_to_string(ws, ' ') as norm, len(ws) as nw from ln),
    whole as (select r, array_to_string(list_transform(ls, lambda x: array_to_string(
                regexp_extract_all({_LOW.format("x")}, '{_WORD}+'), ' ')), chr(10)) as norm from w),
    often as (select nl.source, nl.norm from nl join whole using (r) group by nl.source, nl.norm
              having count(distinct whole.norm) > 30),
    lost as (select nl.r, sum(nw) as n from nl join often on nl.source is not distinct from often.source
               and nl.norm = often.norm group by nl.r),
    m as (select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
            len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
            cast(coalesce(lost.n, 0) as bigint) as n_removed_words
          from w left join rep using (r) left join lost using (r)),
    b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
    select *, not base_failed and n_words - n_removed_words >= (1.0::double / 3) * n_words as kept from b"""

# crc32 bit by bit: the polynomial of zlib, reflected
_CRC = """xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(conv_id as varchar), ''),
    lambda x: cast(ascii(x) as bigint))), lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)),
    lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))))"""
TRIE = f"""with own as (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                        order by turn nulls first) as turns from conversations where conv_id is not null group by conv_id),
    cut as (select *, cast({_CRC} % 6 as int) as h from own),
    made as (select c.conv_id, list_concat(coalesce(b.turns, c.turns[1:0])[1:c.h], c.turns[c.h + 1:]) as turns
             from cut c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
    steps as (select conv_id, cast(d as bigint) as depth, turns[1:d] as path, d = len(turns) as last
              from made, generate_series(0, len(turns)) s(d)),
    nodes as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
                sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where last), '')) as ends_sha256
              from steps group by path, depth),
    kids as (select path[1:depth - 1] as up, depth - 1 as at, count(*) as n from nodes where depth > 0 group by all),
    n2 as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join kids k on k.up = n.path and k.at = n.depth),
    sums as (select path[1:d] as up, cast(d as bigint) as at, sum(case when n_children = 0 then 1 else 0 end) as n_leaves,
               sum(case when depth > 0 then (n_convs - 1) * length(path[depth].t) else 0 end) as saved
             from n2, generate_series(0, depth) s(d) group by all)
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, cast(s.n_leaves as bigint) as n_leaves,
      cast(s.saved as bigint) as saved_tokens, n.ends_sha256
    from n2 n join sums s on s.up = n.path and s.at = n.depth
      left join nodes p on p.path = n.path[1:n.depth - 1] and p.depth = n.depth - 1"""

_FORMED = """case when not plain and spm then {spm} when not plain then {psm} else t end"""
FIM = f"""with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
    u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as us,
            [cast('0x' || substr(h, 8 * k + 1, 8) as bigint) for k in range(4)] as hs from d),
    c as (select *, cast(len(us) as bigint) as n, least(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) as a,
            greatest(hs[1] % (len(us) + 1), hs[2] % (len(us) + 1)) as b, hs[4] % 100 < 20 as spm,
            t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or hs[3] % 100 >= 90 as plain from u),
    s as (select *, array_to_string(us[1:a], '') as p, array_to_string(us[a + 1:b], '') as m, array_to_string(us[b + 1:], '') as z from c)
    select doc_id, n, case when plain then 'plain' when spm then 'spm' else 'psm' end as form,
      case when not plain then cast(length(p) as bigint) end as prefix_chars,
      case when not plain then cast(length(m) as bigint) end as middle_chars,
      sha256({_FORMED.format(spm="'<S>' || z || '<P>' || p || '<M>' || m", psm="'<P>' || p || '<S>' || z || '<M>' || m")}) as output_sha256,
      sha256(t) as restored_sha256 from s"""

_TEMPLATES = ", ".join(f"('{name}', [{', '.join(f"'{g}'" for g in licenses.bigrams_of(text))}])"
                       for name, text in licenses.TEMPLATES.items())

# least / (2 - least), a hair less, as the operator's bounds
_LEAST = "(0.8::double / 1.2::double - 1e-9)"
LICENSES = f"""with templates(license, grams) as (values {_TEMPLATES}),
    d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
    lines as (select r, string_split(t, chr(10)) as ls from d),
    units as (select r, i - 1 as unit, ls[i] as x from lines, generate_series(1, len(ls)) s(i)
              union all select r, -1, t from d where contains(t, chr(10))),
    words as (select r, unit, string_split(trim(regexp_replace({_LOW.format("x")}, '[^a-z0-9]+', ' ', 'g')), ' ') as w from units),
    grams as (select distinct r, unit, w[i] || ' ' || w[i + 1] as g from words, generate_series(1, len(w) - 1) s(i)),
    sizes as (select r, unit, count(*) as n from grams group by all),
    common as (select r, unit, license, len(any_value(grams)) as m, count(*) as c
               from grams join (select license, grams, unnest(grams) as g from templates) x using (g) group by all),
    dice as (select r, unit, license, 2.0::double * c / (n + m) as v from common join sizes using (r, unit)),
    best as (select r, unit, arg_min(license, (-v, license)) as license, max(v) as v from dice where v >= 0.8::double group by all),
    whole as (select distinct r, g from grams),
    near as (select w.r, x.license, any_value(x.grams) as grams from whole w
             join (select license, grams, unnest(grams) as g from templates) x using (g)
             group by w.r, x.license having count(*) >= {_LEAST} * len(any_value(x.grams))),
    few as (select r, ls from lines where contains((select t from d where d.r = lines.r), chr(10)) and r in (select r from near)),
    filled as (select r, i - 1 as i, string_split(trim(regexp_replace({_LOW.format("ls[i]")}, '[^a-z0-9]+', ' ', 'g')), ' ') as w
               from few, generate_series(1, len(ls)) s(i)),
    ordered as (select r, i, w, sum(len(w)) over (partition by r order by i) as upto from filled where w[1] <> ''),
    joined as (select r, flatten(list(w order by i)) as ws from ordered group by r),
    spans as (select a.r, a.i, z.i as j, n.license, n.grams, a.upto - len(a.w) as lo, z.upto as hi
              from ordered a join ordered z on z.r = a.r and z.i > a.i join near n on n.r = a.r
              where z.upto - a.upto + len(a.w) between ceil({_LEAST} * len(n.grams)) + 1 and floor(len(n.grams) / ({_LEAST})) + 1),
    sets as (select s.*, list_distinct(list_transform(range(cast(lo as bigint) + 1, cast(hi as bigint)),
                lambda k: ws[k] || ' ' || ws[k + 1])) as own from spans s join joined using (r)),
    runs as (select r, i, j, license, 2.0::double * len(list_intersect(own, grams)) / (len(own) + len(grams)) as v from sets),
    new as (select r, list(struct_pack(v := -v, i := i, j := j, license := license) order by -v, i, j, license) as rs from runs
            where v >= 0.8::double and not exists (select 1 from best b where b.r = runs.r and b.license = runs.license
                                                     and (b.unit < 0 or b.unit between runs.i and runs.j)) group by r),
    kept as (select r, unnest(list_reduce(list_prepend(rs[1:0], list_transform(rs, lambda x: [x])), lambda acc, x:
               case when len(list_filter(acc, lambda k: k.i <= x[1].j and x[1].i <= k.j)) > 0 then acc
                    else list_concat(acc, x) end)) as m from new),
    matched as (select r, unit, license, v from best union all select r, m.i, m.license, -m.v from kept),
    found as (select r, string_agg(unit || ':' || license || ':' || cast(round(v * 1000000) as bigint), ';' order by unit, license) as matches,
                     string_agg(distinct license, ';' order by license) as licenses, count(*) as n from matched group by r)
    select doc_id, coalesce(matches, '') as matches, coalesce(licenses, '') as licenses,
           cast(coalesce(n, 0) as integer) as n_matches from d left join found using (r)"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
_HELD = ", ".join(f"'{c}'" for c in urls.HELD_OUT)


def _mixed(c: str, size: int, lower: str) -> str:
    return (f"case when t.total_{c} >= {urls.LEAST if size > 1 else 1} "
            f"then (t.{c} + t.kinds_{c} * {lower}) / (t.total_{c} + t.kinds_{c}) else {lower} end")


def _order(size: int) -> str:
    """The probabilities of the grams of one size, from those one character shorter."""
    lower = {c: f"p.p_{c}" if size > 1 else f"(1.0::double / {urls.SYMBOLS})" for c in "ab"}
    join = f" join p{size - 1} p on p.g = substring(t.g, 2)" if size > 1 else ""
    return (f"p{size} as (select t.g, {_mixed('a', size, lower['a'])} as p_a, {_mixed('b', size, lower['b'])} as p_b "
            f"from t{join} where length(t.g) = {size})")


URLS = f"""with rules(v, h, p) as (values {_RULES}),
    u as (select page_id, coalesce(url, '') as url from pages),
    parts as (select url, count(*) as n, {_LOW.format(f"regexp_extract(url, '{urls.PARTS}', 1)")} as host,
                     regexp_extract(url, '{urls.PARTS}', 2) as path from u group by url),
    fits as (select url, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as ruled
             from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by url),
    each as (select parts.*, rule, ruled, md5(url)[1] in ({_HELD}) as held,
                    '{"^" * urls.ORDER}' || regexp_replace(regexp_replace({_LOW.format("url")}, '[0-9]', '0', 'g'),
                                           '[^a-z0\\-./_?=&%#:~]', '~', 'g') || '$' as body
             from parts left join fits using (url)),
    chars as (select url, ruled, held, n, substring(body, i, {urls.ORDER + 1}) as gram
              from each, generate_series(1, length(body) - {urls.ORDER}) s(i)),
    tops as (select gram, coalesce(sum(n) filter (ruled = 'allow' and not held), 0) as a,
                    coalesce(sum(n) filter (ruled = 'block' and not held), 0) as b from chars group by gram),
    ends as (select right(gram, size) as g, sum(a)::double as a, sum(b)::double as b
             from tops, generate_series(1, {urls.ORDER + 1}) s(size) group by all),
    seen as (select left(g, length(g) - 1) as x, sum(a) as total_a, count(*) filter (a > 0) as kinds_a,
                    sum(b) as total_b, count(*) filter (b > 0) as kinds_b from ends group by all),
    t as (select ends.*, seen.* from ends join seen on x = left(g, length(g) - 1)),
    {", ".join(_order(k + 1) for k in range(urls.ORDER + 1))},
    ratios as (select g as gram, cast(round((ln(p_a) - ln(p_b)) * {urls.FLOOR}) as bigint) as ratio from p{urls.ORDER + 1}),
    scored as (select url, cast(floor(sum(ratio)::double / count(*)) as bigint) as score from chars join ratios using (gram) group by url),
    hist as (select floor(score / {urls.STEP}.0::double) as bin, sum(case when ruled = 'allow' then n else 0 end)::double as a,
                    sum(case when ruled = 'block' then n else 0 end)::double as b
             from scored join each using (url) where held and ruled is not null group by 1),
    e as (select bin, sum(a) over (order by bin) - a as missed, sum(b) over (order by bin desc) as passed,
                 sum(a) over () as na, sum(b) over () as nb from hist),
    err as (select bin, missed / greatest(na, 1) + passed / greatest(nb, 1) as x from e),
    cut as (select coalesce(floor((min(bin) + max(bin)) / 2), 0) as bin from err where x = (select min(x) from err))
    select page_id, host, path, rule, score,
           coalesce(ruled, case when floor(score / {urls.STEP}.0::double) >= (select bin from cut) then 'allow' else 'block' end) as verdict
    from u join each using (url) left join scored using (url)"""

ORACLE: dict[str, str] = {"op1_quality": QUALITY, "op3_licenses": LICENSES, "op6_url_filter": URLS,
                          "op11_conversation_trie": TRIE, "op12_fill_in_middle": FIM}
