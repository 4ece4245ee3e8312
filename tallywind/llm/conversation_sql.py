"""SQL for the repair of conversations: the same results by dynamic programming.

A state's best way is kept as text, twelve digits of cost and then the audit, so that the
least text is the cheapest way and of equal ones the ASCII-least audit. One recursive
step per row of a conversation carries the ways of the four states.
"""

from __future__ import annotations


def _more(way: str, cost: str, letter: str) -> str:
    """A way with another edit; null stays null."""
    spent = f"(substr({way}, 1, 12)::bigint + {cost})::varchar"
    return f"lpad({spent}, 12, '0') || substr({way}, 13) || {letter}"


def _inserted(user: str, others: list[str]) -> str:
    return f"least({', '.join([user, *(_more(k, '5', chr(39) + 'I' + chr(39)) for k in others)])})"


def _filled(source: str) -> str:
    """k0 to k3 and the ways that insert turns before the next row."""
    user = _inserted("k2", ["k0", "k1", "k3"])
    return f"""
    select *, {_inserted("k3", ["i2"])} as i3
    from (select *, k0 as i0, k1 as i1, {user} as i2 from {source})"""


def _turned(way: str, role: str) -> str:
    cost = f"late + case when initial = '{role}' then 0 else 1 end"
    letter = f"case when initial = '{role}' then 'K' else 'R' end"
    return f"case when not gone then {_more(way, f'({cost})', letter)} end"


def _deleted(way: str) -> str:
    return _more(way, "2", "'D'")


_CRC = (
    "xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint,"
    " list_transform(string_split(name, ''), lambda ch: ascii(ch)::bigint)),"
    " lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),"
    " lambda x, bit: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)))"
)

SQL = rf"""
with recursive named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
  from conversations
), harmed as (
  select *, {_CRC} % 20 as harm from named
), damaged as (
  select conv_id, turn, case when harm = 4 then 'user' else role end as role,
         case when harm = 1 then '' when harm = 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when harm = 3 then [0, 1] else [0] end) as copy
  from harmed where harm <> 0
), numbered as (
  select conv_id, turn, role, text,
         row_number() over (partition by conv_id order by turn nulls first, role,
                            sha256(length(role)::varchar || ':' || role || text)) as i
  from damaged
), seen as (
  select *, row_number() over (partition by conv_id, role, text order by i) as time,
         regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as ending
  from numbered
), faulty as (
  select conv_id, turn, role, text, i,
         case when substr(role, 1, 1) in ('s', 'u', 'a') then substr(role, 1, 1) else 'o' end as initial,
         case when ending = '' then 'blank' when time > 1 then 'duplicate'
              when ending not in ('.', '!', '?') then 'truncated' else 'none' end as fault
  from seen
), coded as (
  select *, fault in ('blank', 'duplicate') as gone,
         case when fault = 'truncated' then 5 else 0 end as late,
         coalesce(lag(initial) over (partition by conv_id order by i) || initial
                  not in ('su', 'ua', 'au'), false) as wrong
  from faulty
), lengths as (
  select conv_id, max(i) as n, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
         count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (wrong) as illegal
  from coded group by conv_id
), ways as (
  select conv_id, 0::bigint as done, '000000000000' as k0, null::varchar as k1,
         null::varchar as k2, null::varchar as k3
  from lengths
  union all
  select conv_id, done, {_deleted("i0")},
         least({_deleted("i1")}, case when initial = 's' and not gone then {_more("i0", "late", "'K'")} end),
         least({_deleted("i2")}, {_turned("i0", "u")}, {_turned("i1", "u")}, {_turned("i3", "u")}),
         least({_deleted("i3")}, {_turned("i2", "a")})
  from (
    select f.*, c.initial, c.gone, c.late, f.done0 + 1 as done
    from (select conv_id, done as done0, i0, i1, i2, i3 from ({_filled("ways")})) f
    join coded c on f.conv_id is not distinct from c.conv_id and c.i = f.done0 + 1
  )
), best as (
  select w.conv_id, least(i0, i3) as way
  from ({_filled("ways")}) w
  join lengths l on w.conv_id is not distinct from l.conv_id and w.done = l.n
), audits as (
  select conv_id, substr(way, 1, 12)::bigint as cost, substr(way, 13) as audit from best
), letters as (
  select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from audits
), edits as (
  select conv_id, p, substr(audit, p, 1) as letter,
         length(replace(substr(audit, 1, p), 'I', '')) as i,
         (length(replace(substr(audit, 1, p), 'D', '')) - 1
          - length(replace(audit, 'D', '')) % 2) % 2 as place
  from letters
), hashed as (
  select e.conv_id, sha256(string_agg(
           case when letter = 'K' then c.role when place = 0 then 'user' else 'assistant' end
           || ':' || case when letter = 'I' then '' else c.text end, chr(10) order by p)) as digest
  from edits e left join coded c on e.conv_id is not distinct from c.conv_id and e.i = c.i
  where letter <> 'D' group by e.conv_id
)
select o.conv_id, coalesce(l.gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join lengths l on o.conv_id is not distinct from l.conv_id
left join audits a on o.conv_id is not distinct from a.conv_id
left join hashed h on o.conv_id is not distinct from h.conv_id
"""
