"""DuckDB SQL for the queries of this package that SQL can express."""

ORACLES = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op9_mix_sources"] = rf"""
with d as (
    select doc_id, source, text, len({_WORDS})::bigint as size,
           greatest(0.1, 1.0 - 5 * coalesce(len(regexp_extract_all(text, '[#*$%&|<>]'))
                                            / greatest(length(text), 1)::double, 0)) as quality,
           ('0x' || substr(md5('mix' || coalesce(doc_id::varchar, '')), 1, 13))::bigint as drawn
    from documents),
keyed as (select *, -ln((drawn + 1) / 4503599627370496.0::double) / quality as draw from d),
s as (select source, sum(size)::bigint as source_size,
             row_number() over (order by source asc nulls last) as place from d group by source),
w as (select *, (place - 1) % 3 + 1 as weight, 3 * source_size as cap from s),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over earlier, 0))::double
                / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::double as level
      from w window earlier as (order by cap / weight, place rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, least(cap::double, max(level) over () * weight) as target from l),
r as (select k.*, t.source_size, t.target,
             case when t.source_size > 0 then floor(t.target / t.source_size)::int else 0 end as epochs,
             coalesce(sum(size) over (partition by k.source order by draw, doc_id, size
                                      rows between unbounded preceding and 1 preceding), 0) as before
      from keyed k join t on k.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (size * (epochs + case when epochs < 3 and before + size / 2 <= target - epochs * source_size
                              then 1 else 0 end))::bigint as taken
from r"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_LETTERS = " || ".join(
    f"substr({_B32}, ((('0x' || substr(hexed, {1 + 5 * g}, 5))::bigint >> {shift}) & 31)::int + 1, 1)"
    for g in range(8) for shift in (15, 10, 5, 0))

ORACLES["op10_warc_revisits"] = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
h as (select page_id, strlen(payload)::bigint as payload_bytes, sha1(payload) as hexed from p),
d as (select page_id, payload_bytes, {_LETTERS} as payload_digest from h),
m as (select *, max(page_id) over (partition by payload_digest) as original from d)
select page_id, payload_bytes, payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id = original then null else original end as refers_to
from m"""

_SHARES = {
    "symbols": "1000 * n_symbols // greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
    "word_length": "100 * word_chars // greatest(n_words, 1)"}
_MEASURES = " union all ".join(
    f"select doc_id, lang, source, '{name}' as measure, {value} as value from counts"
    for name, value in _SHARES.items())
_CUT = "greatest(length(ltrim(bin(value), '0')) - 6, 0)::int"


def _level(name: str, group: str) -> str:
    """Quantiles of the values rounded down to six leading bits, by group."""
    by = f"{group}, " if group else ""
    return f"""{name} as (
    select {by}measure, any_value(total) as documents,
           min(case when 100 * place >= total then bucket end) as low,
           min(case when 100 * place >= 50 * total then bucket end) as middle,
           min(case when 100 * place >= 99 * total then bucket end) as high
    from (select *, row_number() over (partition by {by}measure order by bucket) as place,
                 count(*) over (partition by {by}measure) as total from measures)
    group by {by}measure)"""


ORACLES["op4_adaptive_rules"] = rf"""
with w as (select doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as words,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
g as (select doc_id, i, array_to_string(words[i:i+7], ' ') as gram
      from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w)),
r as (select doc_id, i, count(*) over (partition by doc_id, gram) as times from g),
c as (select doc_id, count(distinct i + k) as covered
      from r, (select unnest(range(0, 8)) as k) where times > 1 group by doc_id),
counts as (
    select w.doc_id, lang, source, len(words)::bigint as n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
           len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(covered, 0)::bigint as n_repeat_words
    from w left join c on w.doc_id = c.doc_id),
measures as (select *, (value >> {_CUT}) << {_CUT} as bucket from ({_MEASURES})),
{_level("own", "lang, source")}, {_level("by_lang", "lang")}, {_level("overall", "")},
fences as (
    select o.lang, o.source, o.measure,
           case when o.documents >= 100 then o.high when l.documents >= 100 then l.high else a.high end
           + coalesce(case when o.documents >= 100 then nullif(o.high - o.middle, 0) end,
                      case when l.documents >= 100 then nullif(l.high - l.middle, 0) end,
                      nullif(a.high - a.middle, 0)) as high,
           case when o.measure = 'word_length' then
               case when o.documents >= 100 then o.low when l.documents >= 100 then l.low else a.low end
               - coalesce(case when o.documents >= 100 then nullif(o.middle - o.low, 0) end,
                          case when l.documents >= 100 then nullif(l.middle - l.low, 0) end,
                          nullif(a.middle - a.low, 0)) end as low
    from own o join by_lang l on o.lang is not distinct from l.lang and o.measure = l.measure
    join overall a on o.measure = a.measure),
failed as (
    select m.doc_id, string_agg(m.measure, ',' order by case m.measure when 'symbols' then 1
               when 'dup_lines' then 2 when 'repeats' then 3 else 4 end) as failed
    from measures m join fences f on m.lang is not distinct from f.lang
        and m.source is not distinct from f.source and m.measure = f.measure
    where m.bucket > high or m.bucket < low
    group by m.doc_id)
select c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed, coalesce(failed, '') as failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and failed is null as kept
from counts c left join failed f on c.doc_id = f.doc_id"""


ORACLES["op11_window_dedup"] = rf"""
with w as (select doc_id, {_WORDS} as words from documents),
p as (select doc_id, unnest(range(1, len(words) - 48)) as i, words from w where len(words) >= 50),
g as (select doc_id, i, array_to_string(words[i:i+49], ' ') as gram from p),
f as (select gram, min(doc_id) as first from g group by gram),
hit as (select g.doc_id, list(g.i) as starts from g join f on g.gram = f.gram where f.first < g.doc_id group by g.doc_id),
gone as (select doc_id, list_distinct(flatten(list_transform(starts, lambda s: range(s, s + 50)))) as places from hit),
k as (select w.doc_id, words, coalesce(places, []::bigint[]) as places from w left join gone on w.doc_id = gone.doc_id),
one as (select doc_id, len(words)::bigint as n_words, len(places)::bigint as n_removed, words, places from k),
rest as (select doc_id, string_agg(word, ' ' order by place) as kept
         from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from one) x
         where not exists (select 1 from (select doc_id as d, unnest(places) as spot from one) y
                           where y.d = x.doc_id and y.spot = x.place)
         group by doc_id)
select one.doc_id, n_words, n_removed, sha256(coalesce(kept, '')) as kept_sha256
from one left join rest on one.doc_id = rest.doc_id"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, bit by bit (polynomial 0xEDB88320)."""
    eight = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen({text}) + 1), "
            f"lambda i: ('0x' || substr(hex(encode({text})), (2 * i - 1)::bigint, 2))::bigint)), "
            f"lambda c, b: {eight}), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


_OTHER_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang"))
#: One level of trees(tree, level, place, digest): pairs of neighbours.
_PAIRS = """select tree, level + 1, place // 2, any_value(of), sha256(string_agg(digest, '' order by place))
    from {name} where of > 1 << level group by tree, level, place // 2"""

ORACLES["op12_merkle_manifest"] = rf"""
with recursive d as (
    select doc_id, lang, sha256({_OTHER_FIELDS} || {_field("n_chars")} || {_field("text")}) as leaf,
           sha256({_OTHER_FIELDS} || {_field(f"(n_chars + case when {_crc32('doc_id::varchar')} % 7 = 0 then 1 else 0 end)")}
                  || {_field("text")}) as claimed
    from documents),
leaves as (select *, coalesce('=' || lang, '') as tree,
                  row_number() over (partition by lang order by doc_id) - 1 as place, count(*) over (partition by lang) as of
           from d),
low(tree, level, place, of, digest) as (
    select tree, 0, place, of, leaf from leaves union all {_PAIRS.format(name="low")}),
subroots as (select tree, digest as subroot from low where place = 0 and 1 << level >= of and (level = 0 or 1 << (level - 1) < of)),
ordered as (select *, row_number() over (order by tree) - 1 as place, count(*) over () as of from subroots),
high(tree, level, place, of, digest) as (
    select 'all', 0, place, of, subroot from ordered union all {_PAIRS.format(name="high")}),
top as (select digest as root from high where 1 << level >= of and (level = 0 or 1 << (level - 1) < of)),
steps as (
    select l.doc_id, n.level, n.place < l.place >> n.level as before, n.digest
    from leaves l join low n on n.tree = l.tree and n.place = xor(l.place >> n.level, 1) and l.of > 1 << n.level
    union all
    select l.doc_id, 100 + n.level, n.place < o.place >> n.level, n.digest
    from leaves l join ordered o on o.tree = l.tree
    join high n on n.place = xor(o.place >> n.level, 1) and o.of > 1 << n.level),
proof as (select doc_id, string_agg(digest, '' order by level) as digests from steps group by doc_id),
fold(doc_id, k, upto, digest) as (
    select l.doc_id, 0, case when o.of > 1 then 100 + ceil(log2(o.of))::int else ceil(log2(l.of))::int end, claimed
    from leaves l join ordered o on o.tree = l.tree
    union all
    select f.doc_id, case when f.k < 100 and l.of <= 1 << (f.k + 1) then 100 else f.k + 1 end, f.upto,
           case when f.k < 100 and l.of <= 1 << f.k then f.digest
                when s.digest is null then sha256(f.digest)
                when s.before then sha256(s.digest || f.digest) else sha256(f.digest || s.digest) end
    from fold f join leaves l on l.doc_id = f.doc_id left join steps s on s.doc_id = f.doc_id and s.level = f.k
    where f.k < f.upto)
select l.doc_id, leaf, subroot, root, sha256(coalesce(digests, '')) as proof_sha256, f.digest as folded_root,
       f.digest = root as verified
from leaves l join ordered o on o.tree = l.tree cross join top left join proof p on p.doc_id = l.doc_id
join fold f on f.doc_id = l.doc_id and f.k >= f.upto"""

ORACLES["op13_spelling_variants"] = rf"""
with recursive r as (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                       'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) as run
    from documents),
t as (select doc_id, run, count(*) as times from r group by doc_id, run),
h as (select run, times, {_crc32("(doc_id::varchar || ':' || run)")} as h from t),
v as (select case when h % 31 = 0 then run[:(h % length(run))::bigint] || run[(h % length(run) + 2)::bigint:] else run end as word,
             times from h),
w as (select word, sum(times)::bigint as n from v where length(word) >= 7 group by word having sum(times) >= 2),
k as (select word, n, unnest(range(1, length(word) + 1)) as spot from w),
cut as (select word, n, spot, word[:spot-1] || word[spot+1:] as rest from k),
pairs as (
    select a.word, b.word as near, b.n as near_n from cut a join cut b on a.spot = b.spot and a.rest = b.rest and a.word <> b.word
    union select a.word, b.word, b.n from w a join cut b on a.word = b.rest
    union select b.word, a.word, a.n from w a join cut b on a.word = b.rest),
best as (select word, count(*) as n_near, min_by(near, (-near_n, encode(near))) as near, max(near_n) as near_n from pairs group by word),
m as (select w.word, case when near_n >= 10 * n then near end as form, n, coalesce(n_near, 0)::bigint as n_near,
             case when near_n >= 10 * n then near_n end as form_n
      from w left join best on w.word = best.word),
f(word, root, step) as (
    select word, word, 0 from m union all
    select f.word, m.form, step + 1 from f join m on f.root = m.word where m.form is not null)
select m.word, form, f.root, n, n_near, form_n
from m join (select word, max_by(root, step) as root from f group by word) f on f.word = m.word"""
