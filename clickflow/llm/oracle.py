"""DuckDB SQL of the training-data queries that SQL can express, over the same tables."""

from __future__ import annotations

from clickflow.llm import chat, decontaminate, merkle, quality_rules, suffix_dedup, url_filter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _chat() -> str:
    marks = [chat.TURN, chat.TEXT, chat.ALSO, chat.END, *chat.FOREIGN]
    rests = "|".join("".join("\\" + c if c in "|[]" else c for c in m[1:]) for m in marks)
    esc = f"regexp_replace({{}}, '([<\\[])({chat.ESCAPE}*)({rests})', '\\1{chat.ESCAPE}\\2\\3', 'g')"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, t, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(t, r)),
marked as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) is distinct from role as first from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({esc.format('text')}) + case when first
    then {sum(map(len, (chat.TURN, chat.TEXT, chat.END)))} + length({esc.format('role')})
    else {len(chat.ALSO)} end) as bigint) as formatted_chars,
  count(*) filter (where first) as n_messages
from marked group by conv_id"""


def _leaks() -> str:
    n = decontaminate.WINDOW
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
    return f"""
with items as (select cast(item_id as varchar) as item, {words} as w from benchmark),
known as (
  select item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
  from (select item, w, k, unnest(range(1, len(w) - k + 2)) as i
        from (select item, w, least({n}, len(w)) as k from items) where k > 0)),
docs as (select doc_id, {words} as w from documents),
here as (
  select doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
        from docs, (select distinct k from known) where len(w) >= k)),
hits as (select doc_id, item, i, h.k from here h join known b on h.k = b.k and h.win = b.win),
places as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from hits) group by 1),
found as (
  select doc_id, count(item) as n, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by 1)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(p.n, 0) as n_hit, coalesce(f.n, 0) as n_items,
  sha256(coalesce(f.items, '')) as items_sha256, coalesce(p.n, 0) > 0 as contaminated
from docs d left join places p on d.doc_id = p.doc_id left join found f on d.doc_id = f.doc_id"""


def _repeats() -> str:
    """Byte strings as hexadecimal text, two characters a byte."""
    n = suffix_dedup.LENGTH
    return f"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (select doc_id, h, unnest(range(0, length(h) // 2 - {n} + 1)) as i from docs where length(h) >= {2 * n}),
windows as (select doc_id, i, hash(substr(h, 2 * i + 1, {2 * n})) as w from starts),
twice as (select w from windows group by w having count(*) > 1),
hit as (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from windows semi join twice using (w)),
runs as (select doc_id, i, sum(case when before is null or i - before > {n} then 1 else 0 end)
           over (partition by doc_id order by i) as run from hit),
gone as (select doc_id, run, min(i) as lo, max(i) + {n} as hi from runs group by 1, 2),
edges as (
  select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as after from gone),
pieces as (
  select doc_id, after as lo, lo as hi from edges
  union all
  select d.doc_id, coalesce(max(g.hi), 0), length(any_value(d.h)) // 2 from docs d left join gone g on d.doc_id = g.doc_id
  group by d.doc_id),
kept as (
  select p.doc_id, string_agg(substr(d.h, 2 * p.lo + 1, 2 * (p.hi - p.lo)), '' order by p.lo) as h
  from pieces p join docs d on d.doc_id = p.doc_id group by p.doc_id),
sums as (select doc_id, cast(sum(hi - lo) as bigint) as n, count(*) as spans from gone group by doc_id)
select d.doc_id, cast(length(d.h) // 2 as bigint) as n_bytes, coalesce(s.n, 0) as n_removed, coalesce(s.spans, 0) as n_spans,
  sha256(unhex(k.h)) as kept_sha256
from docs d join kept k on k.doc_id = d.doc_id left join sums s on s.doc_id = d.doc_id"""


def _quality() -> str:
    q, w = quality_rules, quality_rules.REPEAT_WINDOW
    share = "case when {1} > 0 then cast({0} as double) / {1} else 0.0 end"
    shares = {"symbol_share": share.format("n_symbols", "word_chars"), "repeat_share": share.format("n_repeat_words", "n_words"),
              "dup_line_share": share.format("n_dup_lines", "n_lines"), "capital_share": share.format("n_capitals", "word_chars"),
              "adjacent_share": share.format("n_adjacent", "n_words")}
    fences = ", ".join(f"quantile_disc({m}, 0.75) + {q.REACH} * greatest(quantile_disc({m}, 0.75) - quantile_disc({m}, 0.25), "
                       f"{least}) as f_{m}" for m, least in q.SPREAD.items())
    outlier = " or ".join(f"{m} > f_{m}" for m in q.SPREAD)
    space = r"[\x09-\x0D\x20]"
    return f"""
with docs as (
  select doc_id, lang, source, coalesce(text, '') as t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '{space}+') if x <> ''] as w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x09-\\x0D\\x20]')] as l
  from documents),
windows as (
  select doc_id, i, list_slice(w, i, i + {w - 1}) as win
  from (select doc_id, w, unnest(range(1, len(w) - {w} + 2)) as i from docs where len(w) >= {w})),
twice as (select doc_id, win from windows group by 1, 2 having count(*) > 1),
repeated as (
  select doc_id, count(distinct p) as n from (
    select a.doc_id, unnest(range(i, i + {w})) as p from windows a join twice b on a.doc_id = b.doc_id and a.win = b.win)
  group by 1),
counts as (
  select d.doc_id, lang, source, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as bigint) as n_capitals,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, len(l) as n_lines,
    coalesce(r.n, 0) as n_repeat_words,
    len([i for i in range(2, len(w) + 1) if w[i] = w[i - 1]]) as n_adjacent
  from docs d left join repeated r on d.doc_id = r.doc_id),
shares as (select *, {', '.join(f'{v} as {k}' for k, v in shares.items())} from counts),
fences as (select lang, source, {fences} from shares group by lang, source),
judged as (
  select s.*, n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words as base_failed, {outlier} as outlier
  from shares s join fences f on s.lang is not distinct from f.lang and s.source is not distinct from f.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not outlier as kept, outlier
from judged"""


def _urls() -> str:
    u = url_filter
    rules = sorted(u.RULES, key=lambda r: (-len(r[0]), -len(r[1]), r))
    fits = "(host = '{0}' or ends_with(host, '.{0}')) and starts_with(path, '{1}')"
    rule = "case " + " ".join(f"when {fits.format(h, p)} then '{h + p}'" for h, p, _ in rules) + " end"
    given = "case " + " ".join(f"when {fits.format(h, p)} then '{v}'" for h, p, v in rules) + " end"
    beside = " or ".join(f"host = '{h}' or ends_with(host, '.{h}')" for h, _, v in rules if v == "block")
    long = ", ".join(f"'{x}'" for x in u.SUFFIXES)

    def last(host: str, n: int) -> str:
        return f"array_to_string(string_split({host}, '.')[-{n}:], '.')"

    def labels(host: str, n: int) -> str:
        """The public suffix and n labels in front of it."""
        return f"case when {last(host, 2)} in ({long}) then {last(host, 2 + n)} else {last(host, 1 + n)} end"

    strength = f"""(select case when binomial is null or binomial = 0 then {u.LEAST_STRENGTH}
      when scatter > binomial then least(greatest((most - scatter) / (scatter - binomial), {u.LEAST_STRENGTH}), {u.MOST_STRENGTH})
      else {u.MOST_STRENGTH} end from (
        select sum((k - n * prior) ** 2) as scatter, sum(n * prior * (1 - prior)) as binomial,
               sum(n * n * prior * (1 - prior)) as most from {{0}}))"""
    level = """{0}_n as (select c.*, a.mean as prior from (select {1}, {0}, sum(k) as k, sum(n) as n from counts group by 1, 2) c
    join {1}_p a on a.{1} = c.{1}),
  {0}_s as (select """ + strength.format("{0}_n") + """ as s),
  {0}_p as (select {0}, (k + prior * s) / (n + s) as mean, n + s as strength from {0}_n, {0}_s)"""
    return f"""
with urls as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
ruled as (select *, {rule} as rule, {given} as given from urls),
counts as (
  select {labels('host', 0)} as suffix, {labels('host', 1)} as domain, host,
    cast(sum(case when given = 'block' then 1 else 0 end) as double) as k, cast(count(*) as double) as n
  from ruled where given is not null or {beside} group by host),
overall as (select case when sum(n) > 0 then (sum(k) + 0.5) / (sum(n) + 1) else 0.5 end as prior from counts),
suffix_n as (select suffix, sum(k) as k, sum(n) as n, (select prior from overall) as prior from counts group by 1),
suffix_s as (select {strength.format('suffix_n')} as s),
suffix_p as (select suffix, (k + prior * s) / (n + s) as mean, n + s as strength from suffix_n, suffix_s),
{level.format('domain', 'suffix')},
{level.format('host', 'domain')},
best as (
  select r.*, coalesce(h.mean, d.mean, s.mean, (select prior from overall)) as mean,
    coalesce(h.strength, d.strength, s.strength, {u.LEAST_STRENGTH}) as strength
  from ruled r left join host_p h on r.host = h.host
    left join domain_p d on {labels('r.host', 1)} = d.domain
    left join suffix_p s on {labels('r.host', 0)} = s.suffix)
select page_id, host, path, rule,
  coalesce(given, case when mean - {u.Z} * sqrt(mean * (1 - mean) / (strength + 1)) > {u.BLOCK_RATE} then 'block' else 'allow' end) as verdict
from best"""


def _audit() -> str:
    """Every order step by step; a filter's share of all orders by adding up its rows."""
    space = r"[\x09-\x0D\x20]"
    letters = "ABCDE"
    orders = " || ".join(f"{x}.f" for x in "pqrst")
    joins = "letters p" + "".join(
        f", letters {x}" for x in "qrst")
    differ = " and ".join(f"{a}.f <> {b}.f" for i, a in enumerate("pqrst") for b in "pqrst"[i + 1:])
    return f"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '{space}+') if x <> ''] as w from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failed as (
  select d.part, coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic,
    case when len(w) < 200 then 'A' else '' end
    || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
    || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when d.doc_id > min(d.doc_id) over (partition by t) then 'E' else '' end as fails
  from docs d left join marks m on d.doc_id = m.doc_id),
cells as (
  select part, fails, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from failed group by 1, 2),
letters as (select unnest(string_split('{",".join(letters)}', ',')) as f),
orders as (select {orders} as filter_order from {joins} where {differ}),
steps as (select filter_order, cast(step as integer) as step, substr(filter_order, step, 1) as own,
  substr(filter_order, 1, step - 1) as before from orders, range(1, 6) r(step)),
seen as (
  select c.*, s.*, contains(fails, own) as fails_own,
    before <> '' and regexp_matches(fails, '[' || before || '-]') as gone from cells c, steps s),
rows as (
  select part, filter_order, step, own,
    coalesce(sum(n) filter (where not gone and not fails_own), 0) as kept,
    coalesce(sum(n) filter (where not gone and fails_own), 0) as removed,
    coalesce(sum(n) filter (where gone and fails_own), 0) as redundant,
    coalesce(sum(n) filter (where fails = own), 0) as unique_fails,
    coalesce(sum(good) filter (where not gone and fails_own), 0) as good_lost,
    coalesce(sum(toxic) filter (where not gone and fails_own), 0) as toxic_lost
  from seen group by 1, 2, 3, 4)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley
from rows"""


def _crc_table() -> str:
    """A CTE ``crc_bytes(t)``: the 256 steps of CRC-32, from its reversed polynomial."""
    step = "select i, i as c from range(256) r(i)"
    for _ in range(8):
        step = f"select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from ({step})"
    return f"crc_bytes as (select list(c order by i) as t from ({step}))"


def _crc(text: str) -> str:
    """CRC-32 of an ASCII text, beside a column ``t`` of ``crc_bytes``."""
    codes = f"[ord(substr({text}, cast(k as integer), 1)) for k in range(1, length({text}) + 1)]"
    return (f"xor(list_reduce(list_concat([4294967295], {codes}), "
            "lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)")


def _manifest() -> str:
    """LEVELS levels of each language's tree, then TOP of the root's; a level of one node stays as it is."""
    levels, top = 7, 3
    fields = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", "{text}"]

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in (x.format(text=text) for x in fields)) + ")"

    def level(name: str, below: str, by: str) -> str:
        inner = "partition by " + ", ".join(filter(None, [by, f"i // {merkle.WIDTH}"])) + " order by i"
        whole = f"partition by {by}" if by else ""
        kept = ", ".join(filter(None, [by, f"i // {merkle.WIDTH} as i"]))
        return f"""
{below}_s as (
  select *, coalesce(string_agg(d, '') over ({inner} rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(d, '') over ({inner} rows between 1 following and unbounded following), '') as r,
    count(*) over ({whole}) as n from {below}),
{name} as (select {kept}, case when any_value(n) = 1 then any_value(d) else sha256(string_agg(d, '' order by i)) end as d
  from {below}_s group by {', '.join(filter(None, [by, f'i // {merkle.WIDTH}']))})"""

    names = [f"t{k}" for k in range(levels + 1)]
    tops = [f"u{k}" for k in range(top + 1)]
    trees = ",".join(level(b, a, "lang") for a, b in zip(names, names[1:]))
    roots = ",".join(level(b, a, "") for a, b in zip(tops, tops[1:]))
    paths, joins, fold, proof = [], [], "coalesce(p.other, p.d)", []
    for k, name in enumerate(names[:-1]):
        joins.append(f"join {name}_s a{k} on a{k}.lang is not distinct from p.lang and a{k}.i = p.i // {merkle.WIDTH ** k}")
    for k, name in enumerate(tops[:-1]):
        joins.append(f"join {name}_s b{k} on b{k}.i = s.i // {merkle.WIDTH ** k}")
    steps = [f"a{k}" for k in range(levels)] + [f"b{k}" for k in range(top)]
    folds = []
    for j, x in enumerate(steps):
        folds.append(f"f{j + 1} as (select *, case when n{j} = 1 then f else sha256(l{j} || f || r{j}) end as g from "
                     + ("path" if j == 0 else f"(select * exclude (f, g), g as f from f{j})") + ")")
    cols = ", ".join(f"{x}.l as l{j}, {x}.r as r{j}, {x}.n as n{j}" for j, x in enumerate(steps))
    proof = " || ".join(f"l{j} || r{j}" for j in range(len(steps)))
    return f"""
with {_crc_table()},
leaves as (
  select doc_id, lang, {leaf('text')} as d,
    case when crc % 3 = 0 then {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} end as other
  from (select *, {_crc('cast(doc_id as varchar)')} as crc from documents, crc_bytes)),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, d) - 1 as i from leaves),
t0 as (select lang, i, d from placed),{trees},
subs as (select lang, d, row_number() over (order by lang nulls first) - 1 as i from {names[-1]}),
u0 as (select i, d from subs),{roots},
path as (
  select p.doc_id, p.d as leaf, s.d as subroot, {fold} as f, {cols}
  from placed p join subs s on s.lang is not distinct from p.lang {' '.join(joins)}),
{", ".join(folds)}
select doc_id, leaf, subroot, (select d from {tops[-1]}) as root, sha256({proof}) as proof_sha256, g as folded_root,
  g = (select d from {tops[-1]}) as verified
from f{len(steps)}"""


def oracle_sql() -> dict[str, str]:
    return {"op11_filter_audit": _audit(), "op13_merkle_manifest": _manifest(),
            "op1_chat_formatting": _chat(), "op3_url_filter": _urls(), "op5_decontamination": _leaks(),
            "op9_suffix_array_dedup": _repeats(), "op10_quality_rules": _quality()}
