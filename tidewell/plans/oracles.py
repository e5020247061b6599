"""DuckDB SQL for the registered queries, written from the definitions rather than from the operators:
states step through a recursive query, peers are joined as such, windows are plain filters."""

from __future__ import annotations

from .domain import SLA_MINUTES
from .queries import AS_OF, BEFORE, FIRST_EVENT, HEALTH, HOUR, NOW, OLD_HOUR, PERIODS

_DAY = 86_400_000_000


def _us(moment) -> int:
    return int(moment.timestamp()) * 1_000_000


_TERMS = ", ".join(f"('{t}', '{p}', {r}, {m})" for t, by in SLA_MINUTES.items() for p, (r, m) in by.items())
DOMAIN = f"""
accounts as (select 'CUS-' || lpad(cast(c_custkey as varchar), 6, '0') as customer_id, c_name as customer_name,
    case c_mktsegment when 'MACHINERY' then 'Mid-Market' when 'BUILDING' then 'Enterprise' when 'AUTOMOBILE' then 'Strategic' else 'SMB' end as segment,
    case r_name when 'AMERICA' then 'North America' when 'EUROPE' then 'Europe' when 'ASIA' then 'Asia Pacific' else 'Latin America' end as region,
    c_acctbal as annual_contract_value, ['Standard', 'Enhanced', 'Premium'][c_custkey % 3 + 1] as support_tier
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
products as (select distinct p_brand as product_id from part),
terms as (select tier as support_tier, level as priority, response, cast(minutes as bigint) as resolution from (values {_TERMS}) x(tier, level, response, minutes)),
contracts as (select 'CTR-' || lpad(cast(c_custkey as varchar), 6, '0') || '-' || priority || '-' || v as contract_id, 'CUS-' || lpad(cast(c_custkey as varchar), 6, '0') as customer_id, support_tier, priority, response, resolution,
    case when v = 0 then date '1995-01-01' else date '1998-01-01' end as effective_from,
    case when v = 1 then null when c_custkey % 2 = 0 then date '1998-06-30' else date '1997-12-31' end as effective_to
    from customer, (values (0), (1)) x(v), terms where support_tier = ['Standard', 'Enhanced', 'Premium'][(c_custkey + v) % 3 + 1] and not (c_custkey % 10 = 9 and priority = 'P4')),
tickets as (select 'TKT-' || o_orderkey as ticket_id, 'CUS-' || lpad(cast(o_custkey as varchar), 6, '0') as customer_id, 'Brand#' || (1 + o_orderkey % 25) as product_id, made as created,
    case when o_orderstatus = 'F' then made + (60 + o_orderkey * 37 % 4000) * 60000000 end as closed, case o_orderpriority when '1-URGENT' then 'P1' when '2-HIGH' then 'P2' when '3-MEDIUM' then 'P3' else 'P4' end as priority,
    case o_orderstatus when 'F' then 'resolved' when 'O' then 'open' else 'in_progress' end as final_status, o_orderkey % 13 = 0 as escalated
    from (select *, epoch_us(o_orderdate) + (o_orderkey * 7919 % 86400) * 1000000 as made from orders)),
typed as (select *, case event_type when 'signup' then case when event_id % 17 = 0 then 'ticket_reopened' else 'ticket_created' end when 'click' then 'customer_replied' when 'view' then 'agent_replied'
    when 'error' then ['priority_changed', 'engineering_escalated', 'status_changed', 'agent_assigned'][event_id % 4 + 1]
    else case when event_id % 3 = 0 then 'ticket_resolved' when event_id % 5 = 1 then 'ticket_reopened' else 'status_changed' end end as kind from events),
happenings as (select 'EVT-' || event_id as event_id, event_id as k, (case when user_id % 2 = 0 then 'TKT-' else 'STK-' end) || user_id as ticket_id, 'CUS-' || lpad(cast(user_id as varchar), 6, '0') as customer_id,
    'Brand#' || (1 + user_id % 25) as product_id, kind, epoch_us(ts) as t, case when event_id % 3 <> 0 then 'AGT-' || (event_id % 80) end as agent,
    case when kind in ('ticket_created', 'priority_changed') then 'P' || (1 + event_id % 4) when kind = 'status_changed' then ['in_progress', 'pending_customer', 'closed', 'open', 'resolved'][event_id % 5 + 1] end as val, props as payload
    from typed)"""
_LIVE = "('open', 'in_progress', 'pending_customer')"


def states(at: int) -> str:
    """Common table expressions up to ``states``: one row per ticket at ``at`` with its SLA columns."""
    return f"""
hist as (select *, case when closed <= {at} then closed end as seen from tickets where created <= {at}),
needs(kind, need) as (values ('agent_assigned', 'live'), ('priority_changed', 'live'), ('engineering_escalated', 'live'), ('ticket_resolved', 'live'), ('ticket_reopened', 'ended'), ('customer_replied', 'any'), ('agent_replied', 'any'), ('status_changed', 'move')),
queue as (select e.*, row_number() over (partition by e.ticket_id order by e.t, e.event_id) as n from happenings e left join tickets k on k.ticket_id = e.ticket_id left join hist h on h.ticket_id = e.ticket_id
    where e.t <= {at} and (k.ticket_id is null or h.ticket_id is not null and e.t > coalesce(h.seen, h.created))),
walk as (
    select ticket_id, cast(0 as bigint) as n, customer_id, product_id, case when final_status in {_LIVE} or seen is not null then final_status else 'open' end as status, priority, cast(null as varchar) as agent, created, coalesce(seen, created) as updated, seen as resolved,
        0 as messages, 0 as reopens, cast(escalated and (closed is null or seen is not null) as int) as escalations, 0 as applied, 0 as rejected from hist
    union all select distinct ticket_id, cast(0 as bigint), null, null, null, null, null, null, null, null, 0, 0, 0, 0, 0 from queue where ticket_id not in (select ticket_id from hist)
    union all
    select ticket_id, n, case when birth then ec else customer_id end, case when birth then ep else product_id end,
        case when birth then 'open' when not ok then status when kind = 'status_changed' then val when kind = 'ticket_resolved' then 'resolved' when kind = 'ticket_reopened' or kind = 'customer_replied' and status = 'pending_customer' then 'open' else status end,
        case when birth or ok and kind = 'priority_changed' then val else priority end, case when birth then ea when ok and kind = 'agent_assigned' then coalesce(ea, val) else agent end,
        case when birth then t else created end, case when birth then t when ok then greatest(updated, t) else updated end,
        case when birth then null when ok and kind = 'ticket_resolved' then t when ok and kind = 'ticket_reopened' then null else resolved end,
        messages + cast(ok and kind like '%replied' as int), reopens + cast(ok and kind = 'ticket_reopened' as int), escalations + cast(ok and kind = 'engineering_escalated' as int),
        applied + cast(ok or birth as int), rejected + cast(status is not null and not ok as int)
    from (select w.*, q.n as n_, q.kind, q.t, q.val, q.agent as ea, q.customer_id as ec, q.product_id as ep,
            coalesce(w.status is null and q.kind = 'ticket_created' and q.val in ('P1', 'P2', 'P3', 'P4'), false) as birth,
            coalesce(w.status is not null and q.t >= w.created and case d.need when 'any' then true when 'live' then w.status in {_LIVE} and (q.kind <> 'agent_assigned' or coalesce(q.agent, q.val) is not null)
                when 'ended' then w.status not in {_LIVE} when 'move' then w.status in {_LIVE} and q.val in {_LIVE} or w.status = 'resolved' and q.val = 'closed' else false end, false) as ok
        from walk w join queue q on q.ticket_id = w.ticket_id and q.n = w.n + 1 left join needs d on d.kind = q.kind) s(ticket_id, old_n, customer_id, product_id, status, priority, agent, created, updated, resolved, messages, reopens, escalations, applied, rejected, n, kind, t, val, ea, ec, ep, birth, ok)),
folded as materialized (select * from (select *, row_number() over (partition by ticket_id order by n desc) as last from walk) where last = 1 and status is not null),
states as materialized (select f.*, contract_id, support_tier, resolution, created + resolution * 60000000 as due, cast(floor((created + resolution * 60000000 - coalesce(resolved, {at})) / 60000000) as bigint) as left_, greatest(0, cast(floor((coalesce(resolved, {at}) - created) / 60000000) as bigint)) as age
    from (select f.ticket_id, c.contract_id, c.support_tier, c.resolution, row_number() over (partition by f.ticket_id order by c.effective_from desc nulls last, c.contract_id desc nulls last) as r
        from folded f left join contracts c on c.customer_id = f.customer_id and c.priority = f.priority and cast(make_timestamp(f.created) as date) between c.effective_from and coalesce(c.effective_to, date '9999-12-31')) x join folded f using (ticket_id) where r = 1)"""


def _with(*parts: str, recursive: bool = True) -> str:
    return f"with {'recursive ' if recursive else ''}" + ",".join(parts)


_TERMS_OF = """
priced as (select t.*, c.contract_id, c.support_tier, c.resolution, t.created + c.resolution * 60000000 as due from tickets t left join lateral (select * from contracts c where c.customer_id = t.customer_id and c.priority = t.priority
    and cast(make_timestamp(t.created) as date) between c.effective_from and coalesce(c.effective_to, date '9999-12-31') order by effective_from desc, contract_id desc limit 1) c on true)"""
_COUNT = lambda c: f"cast(count(*) filter (where {c}) as bigint)"
_RATE = lambda c, among: f"round(avg(case when {among} then cast({c} as double) end), 6)"


def _operations(live: str, made: str, done: str) -> str:
    return f"""{_COUNT(made)} as tickets_created, {_COUNT(done)} as tickets_resolved, {_COUNT(live)} as open_backlog, {_COUNT(f"{live} and priority = 'P1'")} as p1_ticket_count, {_COUNT(f"{live} and priority = 'P2'")} as p2_ticket_count,
    round(median(cast((resolved - created) as double) / 60000000) filter (where {done}), 6) as median_resolution_minutes, {_RATE("(resolved > due)", done)} as sla_breach_rate, {_RATE("(escalations > 0)", made)} as escalation_rate, {_RATE("(reopens > 0)", made)} as reopen_rate"""


def _hour(at: int) -> tuple[str, str, str]:
    end = at + 3_600_000_000
    return f"status in {_LIVE}", f"(created >= {at} and created < {end})", f"(coalesce(resolved, -1) >= {at} and coalesce(resolved, -1) < {end})"


def _operations_hour() -> str:
    at = _us(HOUR)
    live, made, done = _hour(at)
    return _with(DOMAIN, states(at + 3_600_000_000 - 1)) + f"""
select product_id, coalesce(s.support_tier, 'unknown') as support_tier, coalesce(segment, 'unknown') as customer_segment, {_operations(live, made, done)}, cast({at} as bigint) as hour
from states s left join accounts a using (customer_id) where {live} or {made} or {done} group by 1, 2, 3"""


def _operations_range() -> str:
    first = _us(OLD_HOUR)
    return _with(DOMAIN, _TERMS_OF, recursive=False) + f""",
hours as (select {first} + h * 3600000000 as hour from range(72) r(h)),
seen as (select hour, p.*, case when closed < hour + 3600000000 then closed end as resolved, cast(escalated and (closed is null or closed < hour + 3600000000) as int) as escalations, 0 as reopens from priced p, hours where created < hour + 3600000000),
s as (select *, case when final_status in {_LIVE} or resolved is not null then final_status else 'open' end as status, created >= hour as fresh, coalesce(resolved >= hour, false) as done from seen)
select hour, product_id, coalesce(s.support_tier, 'unknown') as support_tier, coalesce(segment, 'unknown') as customer_segment, {_operations(f"status in {_LIVE}", "fresh", "done")}
from s left join accounts a using (customer_id) where status in {_LIVE} or fresh or done group by 1, 2, 3, 4"""


def _operations_totals() -> str:
    level = lambda p: f"cast(sum(coalesce(c.{p}, 0) - coalesce(x.{p}, 0)) over (order by h.h) as bigint)"
    return _with(DOMAIN, recursive=False) + f""",
t as (select created // 3600000000 as c, closed // 3600000000 as x, priority, final_status in {_LIVE} as stays, closed from tickets),
h as (select unnest(range((select min(c) from t), (select greatest(max(c), max(x)) + 1 from t))) as h),
c as (select c as h, count(*) as n, count(*) filter (where closed is null or stays or x > c) as o, count(*) filter (where (closed is null or stays or x > c) and priority = 'P1') as p1, count(*) filter (where (closed is null or stays or x > c) and priority = 'P2') as p2 from t group by 1),
x as (select x as h, count(*) as n, count(*) filter (where not stays and x > c) as o, count(*) filter (where not stays and x > c and priority = 'P1') as p1, count(*) filter (where not stays and x > c and priority = 'P2') as p2 from t where x >= c group by 1)
select * from (select h.h * 3600000000 as hour, cast(coalesce(c.n, 0) as bigint) as tickets_created, cast(coalesce(x.n, 0) as bigint) as tickets_resolved, {level("o")} as open_backlog, {level("p1")} as p1_ticket_count, {level("p2")} as p2_ticket_count
    from h left join c on c.h = h.h left join x on x.h = h.h) where tickets_created + tickets_resolved + open_backlog > 0"""


_LANDED = """, k as (select *, k * 3 // (select max(event_id) + 1 from events) as own, k % 50 in (1, 2, 3, 4) as bad, case k % 50 when 1 then 'n' when 2 then 'b' when 3 then 'l' when 4 then 'j' || k else 'e' || k end as what from happenings where k % 50 <> 5),
lines as (select *, own as b from k union all select *, own from k where k % 10 = 0 union all select *, own + 1 from k where k % 10 = 0 and own < 2),
-- A malformed line is known by its file too.
once as (select min(b) as b, any_value(event_id) as event_id, bad, any_value(t // 1000 * 1000) as t from lines group by what, bad, case when bad then b end),
marks as (select b, max(max(t) filter (where not bad)) over (order by b) as top from once group by b),
landed as (select o.*, m.top - 3600000000 as mark from once o left join marks m on m.b = o.b - 1)"""


def _health() -> str:
    at = _us(HEALTH)
    live, recent, done = f"status in {_LIVE}", f"created >= {at - 90 * _DAY}", f"(coalesce(resolved, -1) >= {at - 90 * _DAY} and coalesce(resolved, -1) < {at})"
    return _with(DOMAIN, states(at - 1)) + f""",
t as (select customer_id, {_COUNT(live)} as o, {_COUNT(f"{live} and priority = 'P1'")} as p, {_COUNT(f"created >= {at - 30 * _DAY}")} as c, {_RATE("(resolved > due)", done)} as breach_rate_90d, {_RATE("(escalations > 0)", recent)} as escalation_rate_90d,
    {_RATE("(reopens > 0)", recent)} as reopen_rate_90d, round(avg(cast(resolved - created as double) / 60000000) filter (where {done}), 6) as average_resolution_minutes from states group by 1)
select customer_id, support_tier, round(annual_contract_value, 6) as annual_contract_value, coalesce(o, 0) as open_ticket_count, coalesce(p, 0) as p1_ticket_count, coalesce(c, 0) as ticket_count_30d, breach_rate_90d, escalation_rate_90d, reopen_rate_90d, average_resolution_minutes, cast({at} as bigint) as as_of
from accounts left join t using (customer_id)"""


def _incident_hour() -> str:
    at = _us(HOUR)
    _, now, _ = _hour(at)
    before = f"(created >= {at - 7 * _DAY} and created < {at} and (created // 3600000000) % 24 = {HOUR.hour})"
    return _with(DOMAIN, states(at + 3_600_000_000 - 1)) + f""",
c as (select product_id, {_COUNT(now)} as n, cast(count(distinct case when {now} then customer_id end) as bigint) as u, {_COUNT(f"{now} and priority = 'P1'")} as p, {_COUNT(f"{now} and escalations > 0")} as e, {_COUNT(before)} as b from states group by 1),
r as (select product_id, coalesce(n, 0) as n, coalesce(u, 0) as u, coalesce(p, 0) as p, coalesce(e, 0) as e, coalesce(b, 0) / 7.0::double as base from products left join c using (product_id))
select cast({at} as bigint) as time_window, product_id, n as ticket_count, u as unique_customers, p as p1_count, e as escalation_count, round(base, 6) as ticket_volume_baseline, round(n - base, 6) as volume_deviation, n >= 5 and u >= 3 and n >= 2 * base as incident_signal from r"""


_INCIDENTS = """
with e as (select 'PRD-' || (user_id % 7) as product_id, user_id, event_id, event_type, epoch_us(ts) as t, epoch_us(ts) // 3600000000 * 3600000000 as h from events),
c as (select product_id, h, count(*) as n, count(distinct user_id) as u, count(*) filter (where event_id % 4 = 0) as p, count(*) filter (where event_type = 'error') as x from e group by 1, 2),
b as (select c.*, cast((select count(*) from e where e.product_id = c.product_id and e.h < c.h and e.h >= c.h - 7 * 86400000000 and (e.h - c.h) % 86400000000 = 0) as double) / 7 as base from c)
select cast(h as bigint) as time_window, product_id, n as ticket_count, u as unique_customers, p as p1_count, x as escalation_count, round(base, 6) as ticket_volume_baseline, round(n - base, 6) as volume_deviation, n >= 5 and u >= 3 and n >= 2 * base as incident_signal from b
"""


def _event_counts(at: int) -> str:
    return f"(select ticket_id, {_COUNT("kind = 'customer_replied'")} as customer_message_count, {_COUNT("kind = 'agent_replied'")} as agent_message_count, {_COUNT("kind = 'priority_changed'")} as priority_change_count from happenings where t < {at} group by 1)"


def _peer(key: str, at: int, days: tuple[int, int, int]) -> str:
    count, esc, breach = (at - d * _DAY for d in days)
    return f"""(select a.ticket_id, count(*) filter (where p.created >= {count}) as peers, {_RATE("(p.resolved > p.due)", f"p.resolved >= {breach}")} as breach_rate, {_RATE("(p.escalations > 0)", f"p.created >= {esc}")} as escalation_rate
    from (select ticket_id, {key} from states where status in {_LIVE}) a left join states p on p.{key} = a.{key} and p.ticket_id <> a.ticket_id group by 1)"""


def _features() -> str:
    at = _us(AS_OF)
    return _with(DOMAIN, states(at - 1)) + f"""
select cast({at} as bigint) as as_of, s.ticket_id, age as ticket_age_minutes, left_ as minutes_to_sla, priority, s.support_tier, segment as customer_segment, cast(messages as bigint) as message_count,
    coalesce(customer_message_count, 0) as customer_message_count, coalesce(agent_message_count, 0) as agent_message_count, cast(reopens as bigint) as reopen_count, coalesce(priority_change_count, 0) as priority_change_count, cast(escalations as bigint) as previous_escalation_count,
    c.peers as customer_ticket_count_30d, c.breach_rate as customer_breach_rate_90d, c.escalation_rate as customer_escalation_rate_90d, p.peers as product_ticket_count_24h, p.escalation_rate as product_escalation_rate_24h, p.breach_rate as product_breach_rate_7d
from states s left join accounts a using (customer_id) left join {_peer("customer_id", at, (30, 90, 90))} c on c.ticket_id = s.ticket_id left join {_peer("product_id", at, (1, 1, 7))} p on p.ticket_id = s.ticket_id left join {_event_counts(at)} e on e.ticket_id = s.ticket_id
where status in {_LIVE}"""


def _past(key: str, count: int, esc: int, breach: int) -> str:
    back = max(esc, breach, count)
    return f"""(select a.ticket_id, count(*) filter (where p.created >= a.as_of - {count}) as n, {_RATE("(p.closed > p.due)", f"p.closed >= a.as_of - {breach} and p.closed < a.as_of")} as b,
    {_RATE("coalesce(p.escalated and p.closed < a.as_of, false)", f"p.created >= a.as_of - {esc}")} as e
    from target a left join source p on p.{key} = a.{key} and p.ticket_id <> a.ticket_id and p.created < a.as_of and (p.created >= a.as_of - {back} or p.closed >= a.as_of - {back} and p.closed < a.as_of) group by 1)"""


def _backfill(select: str = "*") -> list[str]:
    at, hour = _us(BEFORE), 3_600_000_000
    return [DOMAIN, _TERMS_OF, f"""
source as (select *, created // {hour} * {hour} + {hour} as as_of from priced where created < {at}), target as (select * from source where as_of < {at} and (closed is null or closed >= as_of)),
backfilled as (select t.as_of, t.ticket_id, cast(floor((t.as_of - 1 - created) / 60000000) as bigint) as ticket_age_minutes, cast(floor((due - t.as_of + 1) / 60000000) as bigint) as minutes_to_sla, priority, t.support_tier, segment as customer_segment,
    cast(0 as bigint) as message_count, cast(0 as bigint) as customer_message_count, cast(0 as bigint) as agent_message_count, cast(0 as bigint) as reopen_count, cast(0 as bigint) as priority_change_count, cast(0 as bigint) as previous_escalation_count,
    c.n as customer_ticket_count_30d, c.b as customer_breach_rate_90d, c.e as customer_escalation_rate_90d, p.n as product_ticket_count_24h, p.e as product_escalation_rate_24h, p.b as product_breach_rate_7d
    from target t left join accounts a using (customer_id) left join {_past("customer_id", 30 * _DAY, 90 * _DAY, 90 * _DAY)} c on c.ticket_id = t.ticket_id left join {_past("product_id", _DAY, _DAY, 7 * _DAY)} p on p.ticket_id = t.ticket_id)"""]


def _training() -> list[str]:
    label, train, validation, test = map(_us, PERIODS)
    return [*_backfill(), states(label), f"""
training as (select b.*, s.resolved as resolved_at, cast(s.resolved > s.due as bigint) as label, case when b.as_of < {train} then 'train' when b.as_of < {validation} then 'validation' else 'test' end as split
    from (select *, row_number() over (partition by ticket_id order by as_of) as r from backfilled where as_of < {test} and minutes_to_sla > 0) b join states s using (ticket_id)
    where r = 1 and s.resolved > b.as_of and s.resolved <= {label} and s.due is not null and s.reopens = 0)"""]


_RAW_TICKETS = """
raw as (select o_orderkey as k, t.*, case when o_orderkey % 41 = 0 then null when o_orderkey % 43 = 0 then 'TKT-' || (o_orderkey - 1) else ticket_id end as id, case when o_orderkey % 37 = 0 then 'CUS-UNKNOWN' else customer_id end as cust,
    case when o_orderkey % 29 = 0 or o_orderkey % 31 = 0 then null else created end as made, case when o_orderkey % 23 = 0 then 631152000000000 else closed end as shut, lpad(cast(o_orderkey as varchar), 20, '0') as _record_hash
    from orders join tickets t on t.ticket_id = 'TKT-' || o_orderkey),
judged as (select *, list_filter([case when id is null then 'ticket_id: required' end, case when made is null then 'created_at: invalid timestamp' end, case when k % 53 = 0 then 'escalated: invalid boolean' end, case when k % 19 = 0 then 'priority: unsupported value' end,
    case when cust not in (select customer_id from accounts) then 'customer_id: unknown customer' end, case when product_id not in (select product_id from products) then 'product_id: unknown product' end,
    case when k % 47 = 0 then 'final_status: unsupported value' end, case when shut < made then 'closed_at: before created_at' end], lambda x: x is not null) as reasons from raw),
ranked as (select *, case when len(reasons) > 0 then 'quarantined' when cast(substr(id, 5) as bigint) % 10 = 0 then 'rejected_duplicate' else 'fit' end as state from judged),
tried as (select *, case when state <> 'fit' then state when row_number() over (partition by id, state order by k) = 1 then 'accepted' else 'rejected_duplicate' end as disposition, case when len(reasons) > 0 then array_to_string(reasons, '; ') end as failure_reason from ranked)"""

_EVENTS = f"""
raw as (select *, case when k % 41 = 0 then null else ticket_id end as tid, case when k % 37 = 0 then 'nobody' else customer_id end as cust, case when k % 31 = 0 then 'teleported' else kind end as what, case when k % 29 = 0 then null when k % 59 = 0 then 4070908800000000 else t // 1000000 * 1000000 end as moment,
    case when k % 19 = 0 then 'urgent' else lower(val) end as v from happenings),
judged as (select *, list_filter([case when tid is null then 'ticket_id: required' end, case when moment is null then 'event_time: invalid timestamp' end, case when cust not in (select customer_id from accounts) then 'customer_id: unknown customer' end,
    case when product_id not in (select product_id from products) then 'product_id: unknown product' end, case when what = 'teleported' then 'event_type: unsupported value' end, case when k % 13 < 3 then 'payload: invalid JSON object' end,
    case when what in ('priority_changed', 'ticket_created') and coalesce(v not in ('p1', 'p2', 'p3', 'p4'), true) then 'new_value: invalid priority' end,
    case when what = 'status_changed' and coalesce(v not in ('open', 'in_progress', 'pending_customer', 'resolved', 'closed'), true) then 'new_value: invalid status' end,
    case when moment > {_us(NOW) + 300_000_000} then 'event_time: future timestamp outside tolerance' end], lambda x: x is not null) as reasons from raw)"""


def oracle_sql() -> dict[str, str]:
    as_of, health = _us(AS_OF), _us(HEALTH)
    tickets = _with(DOMAIN, _RAW_TICKETS, recursive=False)
    scored = "with s as (select (o_orderkey * 7919 % 1009) / 1009::double as score, cast((o_orderkey * 31 % 97 + o_orderkey * 7919 % 1009 / 20::double) > 90 as int) as label from orders), g as (select score, sum(label) as pos, count(*) as n from s group by 1), c as (select score, pos, n, sum(pos) over (order by score desc) as tp, sum(n) over (order by score desc) as called, sum(pos) over () as p from g)"
    join = """with o as (select o_orderkey as event_id, case when o_orderkey % 2 = 0 then 'customer_001' else 'customer_' || o_custkey end as customer_id from orders), c as (select case when c_custkey = 0 then 'customer_001' else 'customer_' || c_custkey end as customer_id, c_mktsegment as support_tier from customer where c_custkey <> 1)
select support_tier, count(*) as joined_count, cast(sum(event_id) as bigint) as event_id_sum from o join c using (customer_id) group by 1"""
    out = {
        "op_ticket_projection": _with(DOMAIN, recursive=False) + f""" select ticket_id, customer_id, case when final_status in {_LIVE} or closed <= {health} then final_status else 'open' end as status, priority, created as created_at, case when closed <= {health} then closed else created end as last_updated_at,
    case when closed <= {health} then closed end as resolved_at, cast(escalated and (closed is null or closed <= {health}) as bigint) as escalation_count from tickets where created <= {health}""",
        "op_contract_pick": _with(DOMAIN, _TERMS_OF, recursive=False) + " select ticket_id, contract_id, support_tier, cast(resolution as bigint) as resolution_sla_minutes from priced",
        "op_sla_measures": _with(DOMAIN, states(as_of)) + " select ticket_id, contract_id, support_tier, due as sla_deadline, left_ as minutes_to_sla, age as minutes_open from states",
        "op_state_fold": _with(DOMAIN, states(as_of)) + f""" select ticket_id, customer_id, product_id, status, priority, agent as assigned_agent, created as created_at, updated as last_updated_at, resolved as resolved_at, cast(messages as bigint) as message_count, cast(reopens as bigint) as reopen_count,
    cast(escalations as bigint) as escalation_count, cast(applied as bigint) as applied_event_count, cast(rejected as bigint) as rejected_event_count, age as minutes_open, cast({as_of} as bigint) as state_as_of from states where applied + rejected > 0""",
        "op_state_summary": _with(DOMAIN, states(as_of)) + " select count(*) as tickets, cast(coalesce(sum(applied), 0) as bigint) as applied_events, cast(coalesce(sum(rejected), 0) as bigint) as rejected_events, count(*) filter (where left_ < 0) as breaches, count(*) filter (where due is null) as without_sla from states",
        "op_operations_hour": _operations_hour(),
        "op_operations_range": _operations_range(),
        "op_operations_all_hours": _operations_totals(),
        "op_health_snapshot": _health(),
        "op_incident_hour": _incident_hour(),
        "op_incident_signals": _INCIDENTS,
        "op_event_type_counts": _with(DOMAIN, recursive=False) + f" select * from {_event_counts(as_of)}",
        "op_features_snapshot": _features(),
        "op_features_backfill_whole": (_with(*_backfill(), recursive=False) + " select * from backfilled").replace(str(_us(BEFORE)), str(_us(FIRST_EVENT))),
        "op_features_backfill": _with(*_backfill(), recursive=False) + " select * from backfilled",
        "op_peer_customer": _with(DOMAIN, states(health - 1)) + f" select * from {_peer('customer_id', health, (30, 90, 90))}",
        "op_peer_product": _with(DOMAIN, states(health - 1)) + f" select * from {_peer('product_id', health, (1, 1, 7))}",
        "op_validate_tickets": tickets + " select _record_hash, disposition, failure_reason, id as ticket_id, made // 1000000 * 1000000 as created_at, case when k % 19 = 0 then null else priority end as priority, case when k % 47 = 0 then 'lost' else final_status end as final_status, case when k % 53 <> 0 then escalated end as escalated from tried",
        "op_validate_events": _with(DOMAIN, _EVENTS, recursive=False) + """ select lpad(cast(k as varchar), 20, '0') as _record_hash, case when len(reasons) > 0 then 'quarantined' else 'accepted' end as disposition, case when len(reasons) > 0 then array_to_string(reasons, '; ') end as failure_reason, what as event_type, moment as event_time,
    case when what in ('priority_changed', 'ticket_created') and v in ('p1', 'p2', 'p3', 'p4') then upper(v) when v = 'urgent' then 'URGENT' else v end as new_value from judged""",
        "op_validate_accounts": _with(DOMAIN, recursive=False) + """, a as (select *, cast(substr(customer_id, 5) as bigint) as k from accounts), j as (select *, list_filter([case when k % 11 = 0 then 'customer_name: required' end, case when k % 19 = 0 or k % 23 = 0 then 'annual_contract_value: invalid double' end,
    case when k % 13 = 0 then 'segment: unsupported value' end, case when k % 17 = 0 then 'region: unsupported value' end, case when k % 19 <> 0 and k % 23 <> 0 and round(annual_contract_value, 2) < 0 then 'annual_contract_value: outside allowed range' end], lambda x: x is not null) as reasons from a)
    select lpad(cast(k as varchar), 20, '0') as _record_hash, case when len(reasons) > 0 then 'quarantined' else 'accepted' end as disposition, case when len(reasons) > 0 then array_to_string(reasons, '; ') end as failure_reason, case when k % 13 <> 0 then segment end as segment, case when k % 17 <> 0 then region end as region,
    case when k % 19 <> 0 and k % 23 <> 0 then round(annual_contract_value, 2) end as annual_contract_value, support_tier from j""",
        "op_validate_contracts": _with(DOMAIN, recursive=False) + """, a as (select *, cast(substr(customer_id, 5) as bigint) as k, case when cast(substr(customer_id, 5) as bigint) % 17 = 0 then 0 when cast(substr(customer_id, 5) as bigint) % 19 <> 0 then resolution end as res from contracts),
    j as (select *, list_filter([case when k % 13 = 0 then 'response_sla_minutes: invalid integer' end, case when res is null then 'resolution_sla_minutes: invalid integer' end, case when k % 23 = 0 then 'effective_from: invalid date' end,
    case when k % 11 = 0 then 'customer_id: unknown customer' end, case when res = 0 then 'resolution_sla_minutes: outside allowed range' end, case when k % 29 = 0 and k % 23 <> 0 then 'effective_to: before effective_from' end], lambda x: x is not null) as reasons from a)
    select contract_id as _record_hash, case when len(reasons) > 0 then 'quarantined' else 'accepted' end as disposition, case when len(reasons) > 0 then array_to_string(reasons, '; ') end as failure_reason, case when k % 13 <> 0 then cast(response as bigint) end as response_sla_minutes, cast(res as bigint) as resolution_sla_minutes,
    case when k % 23 <> 0 then cast(effective_from as varchar) end as effective_from from j""",
        "op_quality_metrics": tickets + " select count(*) as records_read, count(*) filter (where disposition = 'accepted') as accepted_count, count(*) filter (where disposition = 'rejected_duplicate') as duplicate_count, count(*) filter (where disposition = 'quarantined') as quarantine_count from tried",
        "op_quarantine_reasons": tickets + " select reason, count(*) as rows from (select unnest(reasons) as reason from tried where disposition = 'quarantined') group by 1",
        "op_first_candidate": tickets + " select id as ticket_id, _record_hash from tried where disposition = 'accepted'",
        "op_ref_exists": tickets + " select cust in (select customer_id from accounts) as customer_exists, product_id in (select product_id from products) as product_exists, count(*) as rows from raw group by 1, 2",
        "op_content_hash": """select n_nationkey, sha256('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') as record_hash from nation""",
        "op_insert_only_merge": "select c_custkey, case when c_acctbal >= 0 then 'held' else 'offered' end as version from customer",
        "op_update_only_merge": "select c_custkey, coalesce(n, -1) as orders from customer left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey",
        "op_replace_snapshot": "select event_type, user_id, case when event_type = 'click' then max(event_id) else count(*) end as n from events where event_type in ('signup', 'click', 'error', 'purchase') group by 1, 2",
        "op_replace_range": f"""with d as (select epoch_us(date_trunc('day', ts)) as as_of, count(*) as c, max(event_id) as m from events group by 1)
    select as_of, case when as_of < {_us(HOUR)} then m else c end as n, case when as_of >= {as_of} then 'live' when as_of < {_us(HOUR)} then 'second' else 'first' end as origin from d""",
        "op_time_travel": "select n_nationkey, n_name, cast(1 as bigint) as version from nation union all select n_nationkey, reverse(n_name), 2 from nation",
        "op_validation_run": tickets.replace("when cast(substr(id, 5) as bigint) % 10 = 0 then 'rejected_duplicate' ", "") + """ select count(*) filter (where disposition = 'accepted') as silver_rows, count(distinct case when disposition = 'accepted' then id end) as silver_tickets, count(*) filter (where disposition = 'quarantined') as invalid_rows,
    count(*) as records_read, count(*) filter (where disposition = 'accepted') as accepted_count, count(*) filter (where disposition = 'rejected_duplicate') as duplicate_count, count(*) filter (where disposition = 'quarantined') as quarantine_count, true as repeat_is_equal from tried""",
        "op_stream_parse": _with(DOMAIN, recursive=False) + """, l as (select *, k % 50 in (1, 2, 3, 4) as bad from happenings where k % 50 <> 5)
    select k, case when not bad then event_id end as event_id, case when not bad then kind end as event_type, bad as malformed, case k % 50 when 1 then 'not json' when 2 then '{}}' when 3 then '[1, 2, 3]' when 4 then 'JSON' end as corrupt from l""",
        "op_late_label": _with(DOMAIN, recursive=False) + _LANDED + " select event_id, cast(b as bigint) as batch, coalesce(t < mark, false) as is_late from landed where not bad",
        "op_running_watermark": "with e as (select event_id // 500 as batch, max(epoch_us(ts)) as t from events group by 1) select batch, (select max(t) from e x where x.batch < e.batch) - 3600000000 as watermark from e",
        "op_batch_counters": _with(DOMAIN, recursive=False) + _LANDED + """ select cast(r.b as bigint) as batch_id, r.n as rows_read, w.n as rows_written, r.n - w.n as duplicate_rows, malformed as malformed_rows, late as late_rows, top as max_event_time, mark as watermark
    from (select b, count(*) as n from lines group by 1) r join (select b, count(*) as n, count(*) filter (where bad) as malformed, count(*) filter (where not bad and coalesce(t < mark, false)) as late, any_value(mark) as mark from landed group by 1) w using (b) join marks using (b)""",
        "op_dedup_by_hash": "select distinct l_returnflag, l_linestatus from lineitem",
        "op_training_frame": _with(*_training()) + " select as_of, ticket_id, ticket_age_minutes, minutes_to_sla, customer_ticket_count_30d, product_breach_rate_7d, resolved_at, label, split from training",
        "op_split_counts": _with(*_training()) + " select split, count(*) as rows, cast(sum(label) as bigint) as breaches from training group by 1",
        "op_cohort_check": _with(*_training()) + " select split, count(*) as rows, count(*) filter (where label = 1) as breaches, cast(0 as bigint) as unknown, cast(0 as bigint) as repeated, count(*) filter (where label = 1) between 1 and count(*) - 1 as usable from training group by 1",
        "op_average_precision": scored + " select round(sum(cast(pos as double) / p * tp / called), 6) as average_precision from c",
        "op_roc_auc": scored + " select round(avg(case when a.label = 1 then w end), 6) as roc_auc from (select label, score from s) a join (select score, ((select sum(n - pos) from g x where x.score < g.score) + (n - pos) / 2::double) / (select sum(n - pos) from g) as w from g) b using (score)".replace("(select sum(n - pos) from g x where x.score < g.score)", "coalesce((select sum(n - pos) from g x where x.score < g.score), 0)"),
        "op_best_f1_threshold": scored + ", f as (select score, tp / called::double as pr, tp / p::double as re from c) select round(score, 6) as threshold, round(2 * pr * re / (pr + re), 6) as f1, round(pr, 6) as precision, round(re, 6) as recall from f where pr + re > 0 order by round(2 * pr * re / (pr + re), 12) desc, pr desc, score desc limit 1",
        "op_skewed_range": "with n as (select (select count(*) from orders) as e, (select count(*) from customer) as c), e as (select id, case when id % 100 < 35 then 1 when id % 100 < 50 then 2 else 3 + (id // 100) % (c - 2) end as c from (select unnest(range(e)) as id, c from n)) select ['Premium', 'Standard', 'Enhanced'][c % 3 + 1] as support_tier, count(*) as joined_count, cast(sum(id) as bigint) as event_id_sum from e group by 1",

        "op_open_queue": _with(DOMAIN, states(as_of)) + f" select ticket_id, priority, left_ as minutes_to_sla from states where status in {_LIVE} and left_ is not null order by left_, ticket_id limit 10",
    }
    body = """'{"event_id":"' || event_id || '","ticket_id":"' || ticket_id || '","customer_id":"' || customer_id || '","product_id":"' || product_id || '","event_type":"' || kind || '","event_time":"' || strftime(make_timestamp(t), '%Y-%m-%dT%H:%M:%S.') || lpad(cast(t % 1000000 // 1000 as varchar), 3, '0') || 'Z","agent_id":' || coalesce('"' || agent || '"', 'null') || ',"old_value":null,"new_value":' || coalesce('"' || val || '"', 'null') || ',"payload":' || to_json(payload) || '} junk'"""
    out["op_stream_parse"] = out["op_stream_parse"].replace("'JSON'", body)
    return out | {f"op_join_{n}": join for n in ("default", "merge", "broadcast", "salted")}
