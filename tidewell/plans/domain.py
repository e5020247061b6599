"""The driver's tables as support data: accounts, products, contracts, tickets and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Minutes to response and resolution by tier and priority (fixed values).
SLA_MINUTES = {
    "Standard": {"P1": (120, 480), "P2": (480, 1440), "P3": (1440, 4320), "P4": (2880, 10080)},
    "Enhanced": {"P1": (60, 240), "P2": (240, 720), "P3": (720, 2880), "P4": (1440, 7200)},
    "Premium": {"P1": (30, 120), "P2": (120, 480), "P3": (480, 1440), "P4": (720, 4320)},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its timestamps as UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in rows.dtypes])


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = "case c_mktsegment when 'MACHINERY' then 'Mid-Market' when 'BUILDING' then 'Enterprise' when 'AUTOMOBILE' then 'Strategic' else 'SMB' end"
    region = "case r_name when 'AMERICA' then 'North America' when 'EUROPE' then 'Europe' when 'ASIA' then 'Asia Pacific' else 'Latin America' end"
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.selectExpr(
        "concat('CUS-', lpad(cast(c_custkey as string), 6, '0')) as customer_id", "c_name as customer_name", f"{segment} as segment", f"{region} as region", "'Retail' as industry",
        "c_acctbal as annual_contract_value", "element_at(array('Standard', 'Enhanced', 'Premium'), cast(c_custkey % 3 + 1 as int)) as support_tier", "'active' as account_status",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_brand").distinct()
    return rows.selectExpr("p_brand as product_id", "p_brand as product_name", "'Platform' as product_family", "'platform' as service_owner", "'high' as criticality")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per customer and priority: half overlap, every tenth customer has none for P4."""
    terms = [(t, p, r, m) for t, by in SLA_MINUTES.items() for p, (r, m) in by.items()]
    minutes = F.broadcast(spark.createDataFrame(terms, "support_tier string, priority string, response_sla_minutes int, resolution_sla_minutes int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(*[F.lit(p) for p in ("P1", "P2", "P3", "P4")])).alias("priority")).withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.where("not (c_custkey % 10 = 9 and priority = 'P4')").withColumn("support_tier", F.expr("element_at(array('Standard', 'Enhanced', 'Premium'), cast((c_custkey + v) % 3 + 1 as int))"))
    return rows.join(minutes, ["support_tier", "priority"]).selectExpr(
        "concat('CTR-', lpad(cast(c_custkey as string), 6, '0'), '-', priority, '-', v) as contract_id", "concat('CUS-', lpad(cast(c_custkey as string), 6, '0')) as customer_id", "support_tier", "priority",
        "response_sla_minutes", "resolution_sla_minutes", "if(v = 0, date'1995-01-01', date'1998-01-01') as effective_from",
        "case when v = 1 then null when c_custkey % 2 = 0 then date'1998-06-30' else date'1997-12-31' end as effective_to",
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = "unix_micros(o_orderdate) + (o_orderkey * 7919 % 86400) * 1000000"
    rows = table(spark, sf_dir, "orders").withColumn("made", F.expr(made))
    return rows.selectExpr(
        "concat('TKT-', o_orderkey) as ticket_id", "concat('CUS-', lpad(cast(o_custkey as string), 6, '0')) as customer_id", "concat('Brand#', 1 + o_orderkey % 25) as product_id",
        "timestamp_micros(made) as created_at", "if(o_orderstatus = 'F', timestamp_micros(made + (60 + o_orderkey * 37 % 4000) * 60000000), null) as closed_at",
        "case o_orderpriority when '1-URGENT' then 'P1' when '2-HIGH' then 'P2' when '3-MEDIUM' then 'P3' else 'P4' end as priority", "'web' as channel", "'billing' as category",
        "concat('order ', o_orderkey) as subject", "'-' as description", "cast(null as string) as resolution",
        "case o_orderstatus when 'F' then 'resolved' when 'O' then 'open' else 'in_progress' end as final_status", "o_orderkey % 13 = 0 as escalated", "false as sla_breached", "cast(null as string) as agent_id",
    )


def ticket_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events as ticket events: even users' on tickets with a row, odd users' on tickets known from events alone."""
    kind = """case event_type when 'signup' then if(event_id % 17 = 0, 'ticket_reopened', 'ticket_created') when 'click' then 'customer_replied' when 'view' then 'agent_replied'
        when 'error' then element_at(array('priority_changed', 'engineering_escalated', 'status_changed', 'agent_assigned'), cast(event_id % 4 + 1 as int))
        else if(event_id % 3 = 0, 'ticket_resolved', if(event_id % 5 = 1, 'ticket_reopened', 'status_changed')) end"""
    rows = table(spark, sf_dir, "events").withColumn("kind", F.expr(kind))
    return rows.selectExpr(
        "concat('EVT-', event_id) as event_id", "concat(if(user_id % 2 = 0, 'TKT-', 'STK-'), user_id) as ticket_id", "concat('CUS-', lpad(cast(user_id as string), 6, '0')) as customer_id",
        "concat('Brand#', 1 + user_id % 25) as product_id", "kind as event_type", "ts as event_time", "if(event_id % 3 = 0, null, concat('AGT-', event_id % 80)) as agent_id", "cast(null as string) as old_value",
        "case when kind in ('ticket_created', 'priority_changed') then concat('P', 1 + event_id % 4) when kind = 'status_changed' then element_at(array('in_progress', 'pending_customer', 'closed', 'open', 'resolved'), cast(event_id % 5 + 1 as int)) end as new_value",
        "props as payload",
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as landed text, with faults by key: blank ids, bad enums, naive instants, unknown customers, reversed times, repeats."""
    rows = tickets(spark, sf_dir).withColumn("k", F.expr("cast(substring(ticket_id, 5) as bigint)"))
    iso = lambda c: f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    return rows.selectExpr(
        "case when k % 41 = 0 then '  ' when k % 43 = 0 then concat('TKT-', k - 1) else concat('\\t', ticket_id, ' ') end as ticket_id", "if(k % 37 = 0, 'CUS-UNKNOWN', customer_id) as customer_id", "product_id",
        f"case when k % 29 = 0 then date_format(created_at, 'yyyy-MM-dd HH:mm:ss') when k % 31 = 0 then 'soon' else {iso('created_at')} end as created_at",
        f"if(k % 23 = 0, '1990-01-01T00:00:00Z', {iso('closed_at')}) as closed_at", "case when k % 19 = 0 then 'URGENT' when k % 2 = 0 then lower(priority) else priority end as priority", "channel", "category", "subject",
        "description", "resolution", "case when k % 47 = 0 then 'lost' when k % 3 = 0 then upper(final_status) else final_status end as final_status", "if(k % 53 = 0, '1', if(escalated, 'TRUE', 'false')) as escalated",
        "'false' as sla_breached", "agent_id", "timestamp_micros(k) as _ingested_at", "'file' as _source_file", "'run' as _pipeline_run_id", "lpad(cast(k as string), 20, '0') as _record_hash",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticket_events(spark, sf_dir).withColumn("k", F.expr("cast(substring(event_id, 5) as bigint)"))
    return rows.selectExpr(
        "event_id", "if(k % 41 = 0, null, ticket_id) as ticket_id", "if(k % 37 = 0, 'nobody', customer_id) as customer_id", "product_id", "case when k % 31 = 0 then 'teleported' when k % 2 = 0 then upper(event_type) else event_type end as event_type",
        "case when k % 29 = 0 then 'not-a-timestamp' when k % 59 = 0 then '2099-01-01T00:00:00+00:00' else date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") end as event_time", "agent_id", "old_value",
        "case when k % 19 = 0 then 'URGENT' else lower(new_value) end as new_value", "case k % 13 when 0 then '[1]' when 1 then '{}}' when 2 then 'x' else payload end as payload",
        "timestamp_micros(k) as _ingested_at", "'file' as _source_file", "'run' as _pipeline_run_id", "lpad(cast(k as string), 20, '0') as _record_hash",
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = accounts(spark, sf_dir).withColumn("k", F.expr("cast(substring(customer_id, 5) as bigint)"))
    return rows.selectExpr(
        "customer_id", "if(k % 11 = 0, '', customer_name) as customer_name", "if(k % 13 = 0, 'Tiny', upper(segment)) as segment", "if(k % 17 = 0, 'Moon', lower(region)) as region", "industry",
        "case when k % 19 = 0 then 'NaN' when k % 23 = 0 then 'much' else cast(cast(annual_contract_value as decimal(18, 2)) as string) end as annual_contract_value", "lower(support_tier) as support_tier", "account_status",
        "timestamp_micros(k) as _ingested_at", "'file' as _source_file", "'run' as _pipeline_run_id", "lpad(cast(k as string), 20, '0') as _record_hash",
    )


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts(spark, sf_dir).withColumn("k", F.expr("cast(substring(customer_id, 5) as bigint)"))
    return rows.selectExpr(
        "contract_id", "if(k % 11 = 0, 'nobody', customer_id) as customer_id", "support_tier", "priority", "if(k % 13 = 0, '1.5', cast(response_sla_minutes as string)) as response_sla_minutes",
        "case when k % 17 = 0 then '0' when k % 19 = 0 then '2147483648' else cast(resolution_sla_minutes as string) end as resolution_sla_minutes", "if(k % 23 = 0, '1995', cast(effective_from as string)) as effective_from",
        "if(k % 29 = 0, '1990-01-01', cast(effective_to as string)) as effective_to", "timestamp_micros(k) as _ingested_at", "'file' as _source_file", "'run' as _pipeline_run_id", "contract_id as _record_hash",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and scores with ties, for the ranking metrics."""
    return table(spark, sf_dir, "orders").selectExpr("(o_orderkey * 7919 % 1009) / 1009D as score", "cast((o_orderkey * 31 % 97 + o_orderkey * 7919 % 1009 / 20) > 90 as int) as label")
