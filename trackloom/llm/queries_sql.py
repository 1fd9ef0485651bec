"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from trackloom.llm import chat, secrets
from trackloom.llm.common import LOWER, UPPER
from trackloom.llm.warc import BASE32

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LETTERS = " || ".join(f"substr('{BASE32}', ((('0x' || substr(sha1(p), {5 * i + 1}, 5))::bigint >> {15 - 5 * j}) & 31)::int + 1, 1)" for i in range(8) for j in range(4))

OP1 = f"""
with p as (select page_id, coalesce(html, '') p from pages),
d as (select page_id, strlen(p)::bigint payload_bytes, {_LETTERS} payload_digest from p),
k as (select *, max(page_id) over (partition by payload_digest) keep from d)
select page_id, payload_bytes, payload_digest, case when page_id = keep then 'response' else 'revisit' end record_type,
  case when page_id <> keep then keep end refers_to from k
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP5 = f"""
with b as (select item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') w from benchmark),
bl as (select item_id, w, least(len(w), 10) n from b where len(w) > 0),
span as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') s from (select *, unnest(range(1, len(w) - n + 2)) i from bl)),
d as (select row_number() over () rid, doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') w from documents),
ds as (select rid, n, i, array_to_string(w[i:i + n - 1], ' ') s from (select *, unnest(range(1, len(w) - n + 2)) i from d, (select distinct n from bl))),
hit as (select rid, ds.i, ds.n, item_id from ds join span using (n, s)),
nh as (select rid, count(distinct p) n_hit from (select rid, unnest(range(i, i + n)) p from (select distinct rid, i, n from hit)) group by rid),
ni as (select rid, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct rid, item_id::varchar item_id from hit) group by rid)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join nh using (rid) left join ni using (rid)
"""

OP8 = f"""
with d as (select row_number() over () rid, doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (select rid, doc_id, unnest(ls) line, unnest(range(1, len(ls) + 1)) pos from d),
k as (select *, {_lower(f"trim(line, {_BLANKS})")} key from l),
f as (select key from (select distinct rid, key from k where key <> '') group by key having count(*) >= 10)
select any_value(doc_id) doc_id, count(*)::bigint n_lines, count(f.key)::bigint n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), '')) kept_sha256
from k left join f using (key) group by rid
"""

_KINDS = {
    "assign": (secrets.ASSIGN, 2, 12, 1 << 30),
    "access": (secrets.ACCESS, 0, 0, 1 << 30),
    "hex": (secrets.HEX, 0, 0, 1 << 30),
    "identifier": (secrets.IDENTIFIER, 0, 0, 1 << 30),
    "weak_secret": (secrets.WEAK_SECRET, 0, 0, 1 << 30),
    "short": (secrets.ASSIGN, 2, 6, 11),
    "endpoint": (secrets.ENDPOINT, 0, 0, 1 << 30),
}


def _spans(kind: str) -> str:
    pattern, group, least, most = _KINDS[kind]
    q = _quoted(pattern)
    name = "weak_secret" if kind == "short" else kind
    return f"""select rid, '{name}' kind, start, start + size stop from (
  select rid, v, size, sum(gap) over (partition by rid order by i) + coalesce(sum(size) over (partition by rid order by i rows between unbounded preceding and 1 preceding), 0) start
  from (select rid, i, length(gaps[i]) gap, length(hits[i]) size, vals[i] v from (
    select rid, string_split_regex(t, {q}) gaps, regexp_extract_all(t, {q}) hits, regexp_extract_all(t, {q}, {group}) vals,
      unnest(range(1, len(regexp_extract_all(t, {q})) + 1)) i from d where regexp_matches(t, {q})))) where length(v) between {least} and {most}"""


_RANK = "case kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(secrets.KINDS)) + " end"
_ROLE = "case kind " + " ".join(f"when '{k}' then '{r}'" for k, r in secrets.ROLES.items()) + " end"
_NEED = " or ".join(f"(a.kind = '{k}' and b.role in ({', '.join(map(_quoted, v))}))" for k, v in secrets.NEEDS.items())

OP2 = f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
s as ({" union all ".join(_spans(k) for k in _KINDS)}),
r as (select *, {_ROLE} as role, {_RANK} as rnk from s),
x as (select distinct a.* from r a join r b on a.rid = b.rid and b.start <= a.stop + 200 and b.stop >= a.start - 200 and ({_NEED})),
o as (select *, kind || ':' || start::bigint || ':' || stop::bigint txt from (select * from r where rnk < 3 union select * from x)),
g as (select rid, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
  string_agg(txt, ',' order by start, rnk) filter (rnk < 3) base, string_agg(txt, ',' order by start, rnk, stop) spans from o group by rid)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from d left join g using (rid)
"""



def _escaped(text: str) -> str:
    marks = chat.Template().controls()
    out = f"replace({text}, '\\', '\\\\')"
    for m in marks:
        out = f"replace({out}, '{m}', '{m[0]}\\{m[1:]}')"
    return out


_T = chat.Template()
OP13 = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m as (select *, row_number() over o as i, lag(role) over o as before from c window o as (partition by conv_id order by turn nulls first, role, text)),
s as (select *, length({_escaped("text")}) + case when before = role then {len(_T.joint)} else {len(_T.start + _T.body + _T.end)} + length({_escaped("role")}) end as n from m)
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) turns_sha256,
  coalesce(sum(length(text)) filter (role = '{_T.loss_role}'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = '{_T.loss_role}'), '')) loss_sha256, sum(n)::bigint formatted_chars
from s group by conv_id
"""

ORACLE = {"op1_warc": OP1, "op2_secrets": OP2, "op5_decontamination": OP5, "op8_line_dedup": OP8, "op13_chat_format": OP13}
