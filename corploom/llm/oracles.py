"""DuckDB SQL for the queries of this subpackage, where SQL can state their result."""

from __future__ import annotations

from corploom.llm.licenses import COVERAGE, GRAM, NEAR, PHRASES, TEMPLATES
from corploom.llm.quality import STOP_WORDS
from corploom.llm.secrets import RULES as SECRETS
from corploom.llm.spelling import LEAST_COUNT, LEAST_LETTERS, RATIO, SLIPS
from corploom.llm.urls import RULES as URL_RULES

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

# Places inside a document stand for its row: equal rows get the same counts, one row each.
QUALITY = rf"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text, {_WORDS} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) as lines
  from documents
),
windows as (
  select rid, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from docs)
),
repeated as (
  select rid, i from (
    select rid, i, count(*) over (partition by rid, a, b, c) as n from windows
  ) where n > 1
),
covered as (
  select rid, count(distinct i + k) as n
  from repeated, (select unnest([0, 1, 2]) as k) group by rid
),
measured as (
  select docs.rid, doc_id, len(words)::bigint as n_words,
    length(array_to_string(words, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words,
    len(list_filter(words, lambda w: lower(w) in ({_STOPS})))::bigint as n_stop_words,
    len(list_filter(lines, lambda s: regexp_matches(s, '^[\x20\x09-\x0D]*[-*•]')))::bigint as n_bullets,
    len(list_filter(lines, lambda s: regexp_matches(s, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::bigint as n_dots
  from docs left join covered using (rid)
),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    word_chars between 2 * n_words and 20 * n_words
    and n_symbols <= 0.1 * n_words
    and n_stop_words >= 0.02 * n_words
    and n_dup_lines <= 0.5 * n_lines
    and n_bullets <= 0.9 * n_lines
    and n_dots <= 0.3 * n_lines as passed
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and passed as kept
from judged
"""

# crc32 goes over the bytes of each text with a table of 256 entries made by its rule.
_CRC = """steps(byte, k, v) as (
  select range::bigint, 0, range::bigint from range(256)
  union all
  select byte, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end
  from steps where k < 8
),
crc as (select list(v order by byte) as entries from steps where k = 8)"""


def _crc32(digits: str) -> str:
    """crc32 of the bytes that a hex string stands for; `crc` must be joined."""
    return f"""xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length({digits}) // 2 + 1),
      lambda i: ('0x' || substr({digits}, (2 * i - 1)::bigint, 2))::bigint)),
    lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295)"""


SHARDS = rf"""
with recursive {_CRC},
sized as (
  select doc_id, source, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) + 1
    as size, hex(coalesce(text, '')) as digits,
    md5(concat_ws(':', '101', doc_id::varchar, md5(text))) as key,
    coalesce('=' || source, '-') as src
  from documents
),
summed as (
  select sized.*, {_crc32("digits")} as text_crc32 from sized, crc
),
ranked as (
  select *, (row_number() over (partition by src order by key) - 0.5::double)
    / count(*) over (partition by src) as share
  from summed
),
placed as (
  select *, row_number() over (order by share, src, key) - 1 as pos, count(*) over () as n
  from ranked
)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'rows' as law,
  ((pos * 16) // n)::int as shard,
  (pos - ((pos * 16) // n * n + 15) // 16)::bigint as slot, null::int as grown_shard
from placed
"""


REPEATS = rf"""
with docs as (select row_number() over () as rid, doc_id, {_WORDS} as words from documents),
windows as (
  select rid, doc_id, i, array_to_string(words[i:i + 12], ' ') as content
  from (select rid, doc_id, words, unnest(range(1, len(words) - 11)) as i from docs)
),
gone as (
  select distinct rid, unnest(range(i, i + 13)) as place from (
    select rid, i, doc_id, min(doc_id) over (partition by content) as owner from windows
  ) where owner < doc_id
),
removed as (select rid, list(place) as places from gone group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
  sha256(array_to_string(list_transform(
    list_filter(range(1, len(words) + 1), lambda i: not list_contains(coalesce(places, []), i)),
    lambda i: words[i]), ' ')) as kept_sha256
from docs left join removed using (rid)
"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_URL_RULES = ", ".join(
    f"({_sql(r.name)}, {_sql(r.verdict)}, {_sql(r.pattern)}, {r.layer})" for r in URL_RULES
)
URLS = rf"""
with rules(name, verdict, pattern, layer) as (values {_URL_RULES}),
rests as (
  select row_number() over () as rid, page_id, case when instr(url, '://') > 0
    then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
),
parts as (
  select rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rests
),
winners as (
  select rid, arg_max(struct_pack(name, verdict, layer), (layer, length(name), name)) as won
  from parts join rules on regexp_matches('.' || host || path, pattern) group by rid
)
select page_id, host, path, case when won.layer > 0 then won.name end as rule,
  coalesce(won.verdict, 'allow') as verdict
from parts left join winners using (rid)
"""


def _template_rows() -> str:
    rows = []
    for number, template in enumerate([*PHRASES, *TEMPLATES]):
        words, phrase = template.text.split(), number < len(PHRASES)
        size = len(words) if phrase else GRAM
        grams = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]
        rows += [
            f"({number}, {_sql(template.label)}, {phrase}, {k}, {len(grams)}, {_sql(gram)}, {size})"
            for k, gram in enumerate(grams)
        ]
    return ", ".join(rows)


LICENSES = rf"""
with templates(template, label, phrase, tpos, parts, part, size) as (values {_template_rows()}),
docs as (
  select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), {_AZ}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words
  from documents
),
grams as (
  select rid, i - 1 as pos, words[i] || ' ' || words[i + 1] as two,
    array_to_string(words[i:i + 2], ' ') as three
  from (select rid, words, unnest(range(1, len(words))) as i from docs)
),
hits as (
  select distinct rid, template, label, phrase, parts, tpos, pos, size, pos - tpos as diagonal
  from grams join templates on (size = 2 and two = part) or (size = 3 and three = part)
),
fresh as (
  select *, phrase or coalesce(diagonal - lag(diagonal) over w > {NEAR}, true) as apart
  from hits window w as (partition by rid, template order by diagonal, pos)
),
runs as (
  select *, sum(case when apart then 1 else 0 end)
    over (partition by rid, template order by diagonal, pos rows unbounded preceding) as run
  from fresh
),
merged as (
  select rid, template, any_value(label) as label, any_value(phrase) as phrase, min(pos) as first,
    count(distinct tpos) / any_value(parts) as coverage
  from runs group by rid, template, run
),
found as (
  select rid, count(*) filter (phrase) as n_base, min(first) filter (phrase) as first_word,
    max(first) filter (phrase) as last_word,
    array_to_string(list_sort(list(distinct label) filter (phrase)), ',') as base_labels,
    array_to_string(list_sort(list(distinct label)), ',') as labels, max(coverage) as score
  from merged where coverage >= {COVERAGE} group by rid
)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word,
  last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0)::double as score
from docs left join found using (rid)
"""


def _duck_secrets() -> str:
    """Gaps and matches alternate: a match starts after the gaps and matches before it."""

    def pattern(rule) -> str:
        # DuckDB folds cases beyond ASCII under (?i); spelled out it does not.
        text = rule.pattern.replace("(?i:", "(?:")
        if text != rule.pattern:
            head, _, tail = text.partition("(?:")
            names, _, rest = tail.partition(")")
            names = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)
            text = f"{head}(?:{names}){rest}"
        return text.replace("'", "''")

    parts = []
    for k, rule in enumerate(SECRETS):
        p = pattern(rule)
        parts.append(
            f"""
  select rid, {k} as rank, '{rule.kind}' as kind, unnest(list_transform(range(1, len(m) + 1),
    lambda i: {{'s': list_sum(list_transform(g[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
      'n': length(m[i]), 'p': length(p[i])}})) as x
  from (select rid, regexp_split_to_array(text, '{p}') as g,
    regexp_extract_all(text, '{p}') as m, regexp_extract_all(text, '{p}', {rule.group}) as p
    from docs where regexp_matches(text, '{p}'))"""
        )
    every = "\n  union all".join(parts)
    least = " ".join(f"when {k} then {rule.least}" for k, rule in enumerate(SECRETS))
    return f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
found as ({every}
),
spans as (
  select rid, rank, kind, x.s::bigint as s, (x.s + x.n)::bigint as e from found
  where x.p >= case rank {least} end
),
joined as (
  select rid, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access,
    count(*) filter (rank = 2) as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
  from spans group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from docs left join joined using (rid)
"""


# Every node adds its own part to all nodes on its smallest member's path above it.
TRIE = rf"""
with recursive {_CRC},
turns as (
  select conv_id, turn, md5(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '')
      || coalesce(text, '')) as digest, octet_length(encode(coalesce(text, '')))::bigint as size
  from conversations where conv_id is not null
),
numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, digest, size) as k from turns
),
convs as (
  select conv_id, conv_id - conv_id % 5 as base, {_crc32("hex(conv_id::varchar)")} % 9 as h
  from (select distinct conv_id from turns), crc
),
parts as (
  select c.conv_id, 0 as part, k, digest, size from convs c join numbered t on t.conv_id = c.base and k <= h
  union all
  select c.conv_id, 1, k, digest, size from convs c join numbered t on t.conv_id = c.conv_id and k > h
),
paths as (
  select conv_id, list(digest order by part, k) as path, list(size order by part, k) as sizes
  from parts group by conv_id
  union all
  select conv_id, [], [] from convs where conv_id not in (select conv_id from parts)
),
prefixes as (
  select conv_id, d, md5(array_to_string(path[1:d], '')) as key, md5(array_to_string(path[1:d - 1], '')) as upper,
    case when d > 0 then sizes[d] else 0 end as size, len(path) as length
  from (select *, unnest(range(0, len(path) + 1)) as d from paths)
),
nodes as (
  select d, key, any_value(upper) as upper, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
    coalesce(string_agg(case when length = d then conv_id::varchar end, ',' order by conv_id), '') as ends
  from prefixes group by d, key
),
children as (select d - 1 as d, upper as key, count(*) as n from nodes where d > 0 group by all),
own as (
  select nodes.*, coalesce(n, 0) as n_children, (n_convs - 1) * size as saved from nodes left join children using (d, key)
),
totals as (
  select p.d, p.key, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
  from own u join prefixes p on p.conv_id = u.conv_id and p.d <= u.d group by p.d, p.key
)
select o.conv_id, o.d::bigint as depth, u.conv_id as parent_conv_id, o.n_convs, o.n_children, n_leaves,
  saved_tokens::bigint as saved_tokens, sha256(o.ends) as ends_sha256
from own o join totals using (d, key) left join nodes u on o.d > 0 and u.d = o.d - 1 and u.key = o.upper
"""


# Words one code point apart agree once the same place, or any place of the longer one, is left out.
SPELLING = rf"""
with recursive {_CRC},
runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
),
counted as (
  select run, count(*) as n, hex(concat(doc_id::varchar, ':', run)) as digits
  from runs where length(run) >= {LEAST_LETTERS} group by doc_id, run
),
hashed as (select run, n, length(run) as size, {_crc32("digits")} as h from counted, crc),
slipped as (
  select n, case when h % {SLIPS} <> 0 then run
    else substr(run, 1, (h % size)::bigint) || substr(run, (h % size + 2)::bigint) end as word
  from hashed
),
words as (
  select word, sum(n)::bigint as n from slipped where length(word) >= {LEAST_LETTERS}
  group by word having sum(n) >= {LEAST_COUNT}
),
shorter as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, unnest(range(1, length(word) + 1)) as i from words)
),
near as (
  select a.word, b.word as other from shorter a join shorter b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select word, rest from shorter where rest in (select word from words)
  union select rest, word from shorter where rest in (select word from words)
),
ranked as (
  select near.word, other, o.n as other_n, count(*) over (partition by near.word) as n_near,
    row_number() over (partition by near.word order by o.n desc, other) as place
  from near join words o on o.word = near.other
),
formed as (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
    case when other_n >= {RATIO} * w.n then other end as form,
    case when other_n >= {RATIO} * w.n then other_n end as form_n
  from words w left join ranked r on r.word = w.word and place = 1
),
chain as (
  select word, coalesce(form, word) as root, 0 as links from formed
  union all
  select c.word, f.form, links + 1 from chain c join formed f on f.word = c.root where f.form is not null
),
roots as (select word, arg_max(root, links) as root from chain group by word)
select word, form, root, n, n_near, form_n from formed join roots using (word)
"""


ORACLES = {
    "op2_stratified_shards": SHARDS,
    "op3_fm_repeats": REPEATS,
    "op8_url_rules": URLS,
    "op9_license_diagonals": LICENSES,
    "op10_trigram_secrets": _duck_secrets(),
    "op5_quality_rules": QUALITY,
    "op11_prefix_trie": TRIE,
    "op13_spelling_variants": SPELLING,
}
