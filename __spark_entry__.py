"""

Each query builds a mapping spec (or calls a load / conform / reconcile
operator) over the whole driver tables.  Queries that load a table write it
under a fresh folder of the shared checkpoint root and return the table as
stored.  The "current target" several of them start from is derived from
``customer`` (see ``TARGET_SPEC``): the last load predates the HOUSEHOLD
segment, and the balances of nation 7 were still zero.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapflow import ColumnSpec, JoinSpec, ModelSpec, RunContext, TableRef, TableRegistry, TableStore
from mapflow.fixed_values import DEFAULT_TIME_LOGIC, DEFAULT_USER_LOGIC
from mapflow.operators import (Measure, Rollup, asof_join, assign_surrogate_keys, build_delta, build_model, conform_by_name,
                               create_view, discover_keys,
                               duplicate_keys,
                               load_append, load_insert_by_name, load_landing, load_merge, load_truncate, materialize,
                               ordered_window, publish_view, recon_counts, recon_digest, recon_empty_probe, recon_except)
from mapflow.plans import run_models, spec_job
from mapflow.session import scratch_dir
from mapflow.sources import catalog_columns, column_profile, schema_profile
from mapflow.sources.partitions import PartitionedTable
from mapflow.sources.store import remove_path
from mapflow.streaming import stream_merge, stream_partitions, stream_rollup, stream_windows

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
RUN = RunContext(run_ts=_dt.datetime(2024, 1, 1), run_user="tester")


def _registry(spark: SparkSession, sf_dir: str, store: TableStore | None = None) -> TableRegistry:
    return TableRegistry(spark, store).register_parquet_dir(sf_dir, TABLES, schema="testdata")


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch_dir(spark, "tables"))


def C(target, logic=None, source_table="customer"):
    return ColumnSpec(target, logic, source_table)


# --- specs -------------------------------------------------------------------------

SRC_SPEC = ModelSpec(
    source=TableRef("customer"), target="DW.D_CUSTOMER",
    columns=(C("CUST_ID", "c_custkey"), C("CUST_NM", "c_name"), C("ACCT_BAL", "c_acctbal"),
             C("SEG_CD", "c_mktsegment")),
    unique_key=("CUST_ID",))

TARGET_SPEC = ModelSpec(
    source=TableRef("customer"), target="DW.D_CUSTOMER",
    columns=(C("CUST_ID", "c_custkey"), C("CUST_NM", "c_name"),
             C("ACCT_BAL", "CASE WHEN c_nationkey = 7 THEN 0.0 ELSE c_acctbal END"),
             C("SEG_CD", "c_mktsegment"), C("CREATE_BY", "'old'"), C("UPDATE_BY", "'old'")),
    where="c_mktsegment <> 'HOUSEHOLD'")

# Delta of the source against the current target; stamps the surviving rows.
CHANGE_SPEC = ModelSpec(
    source=TableRef("customer"), target="DW.D_CUSTOMER",
    columns=SRC_SPEC.columns + (C("CREATE_BY", "'new'"), C("UPDATE_BY", "'new'")),
    unique_key=("CUST_ID",), delta=True, materialization="incremental")

DIM_SPEC = ModelSpec(
    source=TableRef("customer"), target="DW.D_CUSTOMER",
    columns=(C("CUST_ID", "c_custkey"), C("CUST_NM", "upper(c_name)"), C("NATION_NM", "n.n_name"),
             C("REGION_NM", "r.r_name"),
             C("BAL_TIER", "CASE WHEN source.c_acctbal > 5000 THEN 'HIGH' ELSE 'STD' END"),
             C("SEG_NATION", "source.c_mktsegment || '/' || n.n_name"),
             C("DATA_SRC", "'DW.D_CUSTOMER'"), C("CREATE_DT", DEFAULT_TIME_LOGIC),
             C("CREATE_BY", DEFAULT_USER_LOGIC)),
    joins=(JoinSpec("LEFT", TableRef("nation"), "n", "c_nationkey = n.n_nationkey"),
           JoinSpec("LEFT", TableRef("region"), "r", "n.n_regionkey = r.r_regionkey")),
    where="main.c_acctbal > 0")


def _seed_target(spark, sf_dir, buckets: int | None = None):
    store = _store(spark)
    reg = _registry(spark, sf_dir, store)
    store.overwrite("DW.D_CUSTOMER", build_model(TARGET_SPEC, reg), (["CUST_ID"], buckets) if buckets else None)
    return reg, store


# --- queries -----------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Customer dimension at sf0.001: two LEFT joins, CASE, concatenation, literal, WHERE, audit."""
    return q_customer_dimension(spark, "/root/testdata/sf0.001")


def q_customer_dimension(spark, d):
    return build_model(DIM_SPEC, _registry(spark, d), RUN)


def q_scan_source(spark, d):
    return _registry(spark, d).resolve(TableRef("supplier", "source"))


def q_scan_ref(spark, d):
    ref_spec = ModelSpec(source=TableRef("DW.D_CUSTOMER", "ref"), target="DW.P_CUSTOMER",
                         columns=(C("CUST_ID", "CUST_ID"), C("ACCT_BAL", "ACCT_BAL")),
                         where="ACCT_BAL > 0", materialization="view")
    out = run_models([ref_spec, SRC_SPEC.with_(materialization="view")], _registry(spark, d))
    return out["DW.P_CUSTOMER"]


def q_catalog_columns_sorted(spark, d):
    return catalog_columns(spark, _registry(spark, d).source("customer")).select("COLUMN_NAME", "ORDINAL_POSITION")


def q_column_profile(spark, d):
    """Columns in ordinal order with row and NULL counts; an outer join gives some NULLs to count."""
    reg = _registry(spark, d)
    joined = reg.source("orders").join(reg.source("customer").where("c_acctbal > 0"), F.expr("o_custkey = c_custkey"), "left")
    return column_profile(joined.select("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment"))


def q_project_logic(spark, d):
    spec = ModelSpec(
        source=TableRef("customer"), target="DW.D_CUSTOMER",
        columns=(C("CUST_ID", "c_custkey"), C("CUST_NM", "upper(c_name)"),
                 C("BAL_FLG", "case when c_acctbal < 0 then 'N' else 'P' end"),
                 C("SEG_NATION", "c_mktsegment || '-' || cast(c_nationkey as varchar(200))"),
                 C("BAL2", "c_acctbal * 2 + 1"), C("DATA_SRC", "'DW.D_CUSTOMER'"), C("UNMAPPED", None),
                 C("List (Y,N)", "Y"), C("CUST_SK", "DW.SEQ_CUSTOMER.NEXTVAL")))
    return build_model(spec, _registry(spark, d), RUN)


def q_project_ddl_order(spark, d):
    contract = T.StructType([T.StructField("SEG_CD", T.StringType()), T.StructField("CUST_ID", T.LongType()),
                             T.StructField("ACCT_BAL", T.DoubleType()), T.StructField("CUST_NM", T.StringType())])
    return build_model(SRC_SPEC.with_(contract=contract), _registry(spark, d), RUN)


def q_audit_stamp(spark, d):
    spec = ModelSpec(
        source=TableRef("customer"), target="DW.D_CUSTOMER",
        columns=(C("CUST_ID", "c_custkey"), C("DATA_SRC", "'DW.D_CUSTOMER'"), C("CREATE_DT", DEFAULT_TIME_LOGIC),
                 C("CREATE_BY", DEFAULT_USER_LOGIC), C("CREATE_PGM", "'DW.D_CUSTOMER'"),
                 C("UPDATE_DT", DEFAULT_TIME_LOGIC), C("UPDATE_BY", DEFAULT_USER_LOGIC),
                 C("UPDATE_PGM", "'DW.D_CUSTOMER'")))
    return build_model(spec, _registry(spark, d), RUN)


def q_filter_where(spark, d):
    spec = ModelSpec(source=TableRef("orders"), target="DW.F_ORDER",
                     columns=(C("ORDER_ID", "o_orderkey", "orders"), C("AMT", "o_totalprice", "orders")),
                     where="main.o_orderstatus = 'F' and main.o_totalprice > 100000")
    return build_model(spec, _registry(spark, d), RUN)


def q_join_left_chain(spark, d):
    spec = ModelSpec(
        source=TableRef("customer"), target="DW.D_CUSTOMER",
        columns=(C("CUST_ID", "c_custkey"), C("NATION_NM", "n.n_name"), C("REGION_NM", "r.r_name")),
        joins=(JoinSpec("LEFT", TableRef("nation"), "n", "c_nationkey = n.n_nationkey and n.n_nationkey < 20"),
               JoinSpec("LEFT", TableRef("region"), "r", "n.n_regionkey = r.r_regionkey")))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_inner(spark, d):
    spec = ModelSpec(
        source=TableRef("orders"), target="DW.F_ORDER",
        columns=(C("ORDER_ID", "o_orderkey", "orders"), C("CUST_NM", "c.c_name", "customer")),
        joins=(JoinSpec("INNER", TableRef("customer"), "c", "source.o_custkey = c.c_custkey"),),
        where="c.c_acctbal > 0")
    return build_model(spec, _registry(spark, d), RUN)


def q_join_theta(spark, d):
    spec = ModelSpec(
        source=TableRef("supplier"), target="DW.D_SUPPLIER",
        columns=(C("SUPP_ID", "s_suppkey", "supplier"), C("NATION_ID", "n.n_nationkey", "nation")),
        joins=(JoinSpec("LEFT", TableRef("nation"), "n", "source.s_nationkey > n.n_nationkey and source.s_acctbal > 0"),))
    return build_model(spec, _registry(spark, d), RUN)


def _supplier_nation(how):
    return ModelSpec(
        source=TableRef("supplier"), target="DW.D_SUPPLIER",
        columns=(C("SUPP_ID", "s_suppkey", "supplier"), C("NATION_ID", "n.n_nationkey", "nation"),
                 C("NATION_NM", "n.n_name", "nation")),
        joins=(JoinSpec(how, TableRef("nation"), "n", "source.s_nationkey = n.n_nationkey and source.s_acctbal > 5000"),))


def q_join_left_split(spark, d):
    """LEFT join whose joined side holds many rows per key, planned skew-safe."""
    spec = ModelSpec(
        source=TableRef("customer"), target="DW.F_CUSTOMER_ORDER",
        columns=(C("CUST_ID", "c_custkey"), C("ORDER_ID", "o.o_orderkey", "orders"),
                 C("AMT", "o.o_totalprice", "orders")),
        joins=(JoinSpec("LEFT", TableRef("orders"), "o", "source.c_custkey = o.o_custkey", skew="split"),))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_right(spark, d):
    return build_model(_supplier_nation("RIGHT"), _registry(spark, d), RUN)


def q_join_full(spark, d):
    return build_model(_supplier_nation("FULL OUTER"), _registry(spark, d), RUN)


def q_group_by(spark, d):
    spec = ModelSpec(
        source=TableRef("orders"), target="DW.A_CUSTOMER_ORDER",
        columns=(C("CUST_ID", "source.o_custkey", "orders"), C("ORDER_CNT", "count(*)", "orders"),
                 C("MAX_AMT", "max(source.o_totalprice)", "orders"),
                 C("PRI_CNT", "count(distinct source.o_orderpriority)", "orders")),
        where="source.o_orderstatus = 'F'", group_by=("source.o_custkey",))
    return build_model(spec, _registry(spark, d), RUN)


def q_group_rollup(spark, d):
    spec = ModelSpec(
        source=TableRef("customer"), target="DW.A_SEGMENT_NATION",
        columns=(C("SEG_CD", "c_mktsegment"), C("NATION_ID", "c_nationkey"), C("CUST_CNT", "count(*)"),
                 C("MAX_BAL", "max(source.c_acctbal)")),
        group_by=("source.c_mktsegment", "source.c_nationkey"), grouping="rollup")
    return build_model(spec, _registry(spark, d), RUN)


def q_group_lineitem(spark, d):
    spec = ModelSpec(
        source=TableRef("lineitem"), target="DW.A_LINE_STATUS",
        columns=(C("RETURN_FLG", "source.l_returnflag", "lineitem"), C("ORDER_STATUS", "o.o_orderstatus", "orders"),
                 C("LINE_CNT", "count(*)"), C("MAX_PRICE", "max(source.l_extendedprice)"),
                 C("SUPP_CNT", "count(distinct source.l_suppkey)")),
        joins=(JoinSpec("INNER", TableRef("orders"), "o", "source.l_orderkey = o.o_orderkey"),),
        group_by=("source.l_returnflag", "o.o_orderstatus"))
    return build_model(spec, _registry(spark, d), RUN)


def q_aggregate_global(spark, d):
    spec = ModelSpec(source=TableRef("orders"), target="DW.A_ORDER",
                     columns=(C("ORDER_CNT", "count(*)", "orders"), C("MAX_AMT", "max(o_totalprice)", "orders")))
    return build_model(spec, _registry(spark, d), RUN)


def q_delta_minus(spark, d):
    reg, store = _seed_target(spark, d)
    spec = SRC_SPEC.with_(columns=SRC_SPEC.columns + (C("DATA_SRC", "'DW.D_CUSTOMER'"),), delta=True)
    return build_delta(spec, reg, store.read("DW.D_CUSTOMER"), RUN)


def q_load_truncate(spark, d):
    reg, store = _seed_target(spark, d)
    return materialize(SRC_SPEC.with_(materialization="truncate_load"), build_model(SRC_SPEC, reg, RUN), store, RUN)


def q_load_append(spark, d):
    reg, store = _seed_target(spark, d)
    store.overwrite("DW.C_NAMES", store.read("DW.D_CUSTOMER").select("CUST_ID", "CUST_NM"))
    spec = ModelSpec(source=TableRef("customer"), target="DW.C_NAMES", materialization="incremental",
                     columns=(C("CUST_ID", "c_custkey"), C("CUST_NM", "c_name")))
    return materialize(spec, build_model(spec, reg, RUN), store, RUN)


def _merge(spark, d, exclude, buckets=None):
    reg, store = _seed_target(spark, d, buckets)
    changes = build_delta(CHANGE_SPEC, reg, store.read("DW.D_CUSTOMER"), RUN)
    return load_merge(store, "DW.D_CUSTOMER", changes, ["CUST_ID"], exclude=exclude)


def q_merge_update_columns(spark, d):
    """Upsert of the delta into a target bucketed by its key: only the batch is shuffled."""
    return _merge(spark, d, exclude=("CREATE_DT", "CREATE_BY", "CREATE_PGM"), buckets=8)


def q_merge_all_columns(spark, d):
    return _merge(spark, d, exclude=())


def _new_customers(reg, store):
    current = store.read("DW.D_CUSTOMER")
    return build_model(SRC_SPEC, reg, RUN).join(current.select("CUST_ID"), "CUST_ID", "left_anti")


def q_insert_by_name(spark, d):
    reg, store = _seed_target(spark, d)
    batch = _new_customers(reg, store).select(F.col("CUST_NM").alias("cust_nm"), F.col("CUST_ID").alias("Cust_Id"),
                                              "SEG_CD")
    return load_insert_by_name(store, "DW.D_CUSTOMER", batch)


def q_surrogate_key(spark, d):
    reg, store = _seed_target(spark, d)
    start = store.read("DW.D_CUSTOMER").agg(F.max("CUST_ID")).first()[0]
    batch = _new_customers(reg, store).select("CUST_ID", "CUST_NM")
    return assign_surrogate_keys(batch, ["CUST_ID"], "CUST_SK", start)


def q_conform_automap(spark, d):
    return conform_by_name(_registry(spark, d).source("supplier"), ["S_SUPPKEY", "S_NAME", "S_COUNTRY", "DATA_SRC"],
                           "DW.D_SUPPLIER", RUN)


def q_landing_load(spark, d):
    """Every column of the source; of the audit names in it, DATA_SRC, the values are replaced."""
    store = _store(spark)
    raw = _registry(spark, d).source("testdata.supplier").withColumn("DATA_SRC", F.lit("raw"))
    return load_landing(store, "LND.SUPPLIER", raw, "testdata.supplier", RUN)


def q_view_lasting(spark, d):
    """A catalog view with its own column list over the stored table."""
    return create_view(spark, "dp_supplier_lasting", f"parquet.`{d}/supplier.parquet`",
                       ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], ["SUPP_ID", "SUPP_NM", "NATION_ID", "BAL"], ctx=RUN)


def q_view_positional(spark, d):
    sup = _registry(spark, d).source("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return publish_view(sup, "dp_supplier", ["SUPP_ID", "SUPP_NM", "NATION_ID", "BAL"])


def q_recon_except(spark, d):
    """Whole rows of the target against the raw source, by position: their names differ."""
    reg, store = _seed_target(spark, d)
    source = reg.source("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.lit("old"), F.lit("old").alias("x"))
    return recon_except(store.read("DW.D_CUSTOMER"), source)


def q_recon_counts(spark, d):
    reg, store = _seed_target(spark, d)
    return recon_counts(store.read("DW.D_CUSTOMER"), build_model(SRC_SPEC, reg, RUN))


def q_recon_empty_probe(spark, d):
    _, store = _seed_target(spark, d)
    return recon_empty_probe(store.read("DW.D_CUSTOMER"))


def q_duplicate_keys(spark, d):
    return duplicate_keys(_registry(spark, d).source("lineitem"), ["l_orderkey"], names=["ORDER_ID"])


def q_model_graph(spark, d):
    store = _store(spark)
    seg = ModelSpec(source=TableRef("DW.D_CUSTOMER", "ref"), target="DW.A_SEGMENT",
                    columns=(C("SEG_CD", "SEG_CD"), C("CUST_CNT", "count(*)"), C("MAX_BAL", "max(ACCT_BAL)")),
                    group_by=("SEG_CD",), materialization="truncate_load")
    out = run_models([seg, SRC_SPEC.with_(materialization="truncate_load")], _registry(spark, d, store), store, RUN)
    return out["DW.A_SEGMENT"]


def q_stream_merge(spark, d):
    """All columns of all events, streamed in four batches that hold every key twice: the later revision stays."""
    store = _store(spark)
    events = _registry(spark, d).source("events").withColumn("rev", F.lit(2))
    stale = events.withColumns({"value": F.lit(-1.0), "props": F.lit("{}"), "rev": F.lit(1)})
    landing = scratch_dir(spark, "landing-events")
    events.union(stale).repartitionByRange(4, "event_id").write.parquet(landing)

    def shape(df, ctx=RUN):
        return df.toDF(*[c.upper() for c in df.columns])

    store.overwrite("RAW.EVENTS", shape(events.where("event_type = 'view'")).withColumn("VALUE", F.lit(0.0)))
    q = stream_merge(spark, landing, events.schema, store, "RAW.EVENTS", ["EVENT_ID"], transform=shape,
                     max_files_per_trigger=1, checkpoint_location=scratch_dir(spark, "stream-checkpoint"), order_by=["REV"])
    q.awaitTermination()
    return store.read("RAW.EVENTS")


def q_delta_truncate_load(spark, d):
    """Truncate-and-load with a delta over a seeded target: the table ends as the whole model."""
    reg, store = _seed_target(spark, d)
    return run_models([SRC_SPEC.with_(delta=True, materialization="truncate_load")], reg, store, RUN)["DW.D_CUSTOMER"]


def q_delta_mixed_types(spark, d):
    """Integer model against a double target: values that only the wider type tells apart are changes."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    store.overwrite("DW.D_NATION_OF", reg.source("customer").selectExpr(
        "c_custkey as CUST_ID", "c_nationkey + if(c_mktsegment = 'BUILDING', 0.5D, 0D) as NATION_ID"))
    spec = ModelSpec(source=TableRef("customer"), target="DW.D_NATION_OF", unique_key=("CUST_ID",), delta=True,
                     columns=(C("CUST_ID", "c_custkey"), C("NATION_ID", "c_nationkey")))
    return build_delta(spec, reg, store.read("DW.D_NATION_OF"), RUN)


def q_join_expr_equi(spark, d):
    """Equality of expressions of both sides: hashed, not looped."""
    spec = ModelSpec(
        source=TableRef("orders"), target="DW.F_ORDER",
        columns=(C("ORDER_ID", "o_orderkey", "orders"), C("CUST_NM", "c.c_name")),
        joins=(JoinSpec("LEFT", TableRef("customer"), "c",
                        "upper(cast(source.o_custkey as string)) = trim(cast(c.c_custkey as string)) and c.c_acctbal > 0"),))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_interval(spark, d):
    """Range condition with both sides large: orders whose total lies within a euro above a line's price, and the others."""
    spec = ModelSpec(
        source=TableRef("orders"), target="DW.F_ORDER_LINE",
        columns=(C("ORDER_ID", "o_orderkey", "orders"), C("LINE_ORDER_ID", "l.l_orderkey", "lineitem"), C("LINE_NO", "l.l_linenumber", "lineitem")),
        joins=(JoinSpec("LEFT", TableRef("lineitem"), "l",
                        "source.o_totalprice >= l.l_extendedprice and source.o_totalprice < l.l_extendedprice + 1 and l.l_quantity > 5"),))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_interval_full(spark, d):
    """FULL join of overlapping intervals: from a line's price on against from an order's total on."""
    spec = ModelSpec(
        source=TableRef("lineitem"), target="DW.F_LINE_ORDER",
        columns=(C("LINE_ORDER_ID", "l_orderkey", "lineitem"), C("LINE_NO", "l_linenumber", "lineitem"), C("ORDER_ID", "o.o_orderkey", "orders")),
        joins=(JoinSpec("FULL", TableRef("orders"), "o",
                        "source.l_extendedprice <= o.o_totalprice + 0.4 and source.l_extendedprice + 0.6 >= o.o_totalprice"),))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_disjunction(spark, d):
    """OR of two equalities, both sides large: each pair once, orders and lines without any match kept."""
    spec = ModelSpec(
        source=TableRef("lineitem"), target="DW.F_LINE_ORDER",
        columns=(C("LINE_ORDER_ID", "l_orderkey", "lineitem"), C("LINE_NO", "l_linenumber", "lineitem"), C("PART_ID", "l_partkey", "lineitem"),
                 C("ORDER_ID", "o.o_orderkey", "orders")),
        joins=(JoinSpec("FULL", TableRef("orders"), "o",
                        "(source.l_orderkey = o.o_orderkey and o.o_orderstatus = 'F') or source.l_partkey = o.o_orderkey"),))
    return build_model(spec, _registry(spark, d), RUN)


def q_join_asof(spark, d):
    """Every event with the latest view of the same user before it, if there is one within five days."""
    events = _registry(spark, d).source("events")
    return asof_join(events.select("event_id", "user_id", "event_type", "ts"), events.where("event_type = 'view'"), [("user_id", "user_id")],
                     "ts", "ts", {"view_id": "event_id", "view_ts": "ts"}, strict=True, ties=["event_id"],
                     tolerance=F.expr("interval 5 days"))


def q_window_hot(spark, d):
    """Running values over groups that hold a large part of all rows (event types)."""
    events = _registry(spark, d).source("events").select("event_id", "event_type", "user_id", "ts")
    return ordered_window(events, ["event_type"], ["ts", "event_id"], {
        "row_no": ("row_number", None), "previous_id": ("lag", "event_id"), "user_sum": ("sum", "user_id"),
        "user_max": ("max", "user_id"), "user_min": ("min", "user_id")})


def q_recon_digest(spark, d):
    """Target against source by checksums: rows of either side that the other lacks."""
    reg, store = _seed_target(spark, d)
    source = build_model(SRC_SPEC, reg, RUN)
    return recon_digest(store.read("DW.D_CUSTOMER").select(*source.columns), source, ["CUST_ID"])


SEQ_SPEC = SRC_SPEC.with_(columns=(C("CUST_SK", "DW.SEQ_CUSTOMER.NEXTVAL"),) + SRC_SPEC.columns)


def _seed_numbered(spark, d):
    """The current target with a surrogate key, numbered in key order."""
    reg, store = _seed_target(spark, d)
    current = store.read("DW.D_CUSTOMER").select("CUST_ID", "CUST_NM", "ACCT_BAL", "SEG_CD")
    load_truncate(store, "DW.D_CUSTOMER", assign_surrogate_keys(current, ["CUST_ID"], "CUST_SK"))
    return reg, store


def q_merge_with_sequence(spark, d):
    """Keyed merge of a mapping with a sequence column: new rows are numbered on, matched rows keep their number."""
    reg, store = _seed_numbered(spark, d)
    return run_models([SEQ_SPEC.with_(materialization="incremental")], reg, store, RUN)["DW.D_CUSTOMER"]


def q_insert_with_sequence(spark, d):
    """INSERT of the model's rows: all are numbered on from the stored maximum."""
    reg, store = _seed_numbered(spark, d)
    return run_models([SEQ_SPEC.with_(materialization="insert", where="c_mktsegment = 'HOUSEHOLD'")], reg, store, RUN)["DW.D_CUSTOMER"]


ORDER_SPEC = ModelSpec(
    source=TableRef("orders"), target="DW.F_ORDER", unique_key=("ORDER_ID",), delta=True, materialization="incremental",
    columns=(C("ORDER_ID", "o_orderkey", "orders"), C("CUST_ID", "o_custkey", "orders"), C("STATUS", "o_orderstatus", "orders"),
             C("AMT", "o_totalprice", "orders"), C("ORDER_DT", "o_orderdate", "orders"), C("PRIO", "o_orderpriority", "orders")))


def q_merge_orders(spark, d):
    """Delta of all orders merged into a bucketed target, then a correction of one customer's orders, which touches few buckets."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    old = ORDER_SPEC.with_(where="o_orderpriority <> '1-URGENT'", delta=False)
    seed = build_model(old, reg, RUN).withColumn("AMT", F.when(F.col("STATUS") == "P", 0.0).otherwise(F.col("AMT")))
    store.overwrite("DW.F_ORDER", seed, (["ORDER_ID"], 64))
    run_models([ORDER_SPEC], reg, store, RUN)
    few = ORDER_SPEC.with_(delta=False, where="o_custkey = 7", columns=ORDER_SPEC.columns[:3] + (
        C("AMT", "o_totalprice * 2", "orders"),) + ORDER_SPEC.columns[4:])
    return run_models([few], reg, store, RUN)["DW.F_ORDER"]


def q_insert_select_joined(spark, d):
    """INSERT from a mapping with joins, filter and grouping; target columns it does not name become NULL."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    store.overwrite("DW.A_NATION", reg.source("nation").selectExpr("n_name as NATION_NM", "0L as ORDER_CNT", "n_regionkey as REGION_ID"))
    spec = ModelSpec(
        source=TableRef("orders"), target="DW.A_NATION", materialization="insert",
        columns=(C("ORDER_CNT", "count(*)"), C("NATION_NM", "n.n_name")),
        joins=(JoinSpec("INNER", TableRef("customer"), "c", "o_custkey = c.c_custkey"),
               JoinSpec("INNER", TableRef("nation"), "n", "c.c_nationkey = n.n_nationkey")),
        where="main.o_orderstatus = 'F'", group_by=("n.n_name",))
    return run_models([spec], reg, store, RUN)["DW.A_NATION"]


def q_job_steps(spark, d):
    """One spec's job: build the table, merge the model into it, insert its rows once more."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    spec = ModelSpec(source=TableRef("part"), target="DW.D_PART", unique_key=("PART_ID",), materialization="truncate_load",
                     columns=(C("PART_ID", "p_partkey", "part"), C("PART_NM", "p_name", "part"), C("PRICE", "p_retailprice", "part")))
    job = spec_job(spec, reg, store, RUN)
    job.run()
    return store.read("DW.D_PART")


def q_group_by_config(spark, d):
    """A workbook's grouping text with several keys, one of them an expression with a comma."""
    spec = ModelSpec.from_config({
        "Source": {"Type": "source", "Database": "LAKE", "Schema": "testdata", "Table Name": "part"},
        "Target": {"Schema": "DW", "Table Name": "A_PART"},
        "Columns": [{"Target Column": "BRAND", "Source Table": "part", "Logic": "source.p_brand"},
                    {"Target Column": "SIZE_CD", "Source Table": "part", "Logic": "coalesce(source.p_size % 5, -1)"},
                    {"Target Column": "PART_CNT", "Source Table": "part", "Logic": "count(*)"},
                    {"Target Column": "MAX_PRICE", "Source Table": "part", "Logic": "max(main.p_retailprice)"}],
        "Group By": "main.p_brand, coalesce(main.p_size % 5, -1)"})
    return build_model(spec, _registry(spark, d), RUN)


def q_merge_chosen_key(spark, d):
    """An incremental mapping without a key, loaded twice: the chosen key (the _ID column) keeps rows single."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    spec = ModelSpec(source=TableRef("part"), target="DW.D_PART", materialization="incremental",
                     columns=(C("PART_NM", "p_name", "part"), C("PART_ID", "p_partkey", "part"), C("PRICE", "p_retailprice", "part")))
    run_models([spec], reg, store, RUN)
    dearer = spec.with_(columns=spec.columns[:2] + (C("PRICE", "p_retailprice + 1", "part"),), where="p_size > 25")
    return run_models([dearer], reg, store, RUN)["DW.D_PART"]


def q_merge_sheet_key(spark, d):
    """Loaded twice by the key cell of the mapping sheet, where the names alone would tell the brand's code as the key."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    sheet = {"Source": {"Schema": "testdata", "Table Name": "part"}, "UNIQUE_KEY": "PART_NO , SIZE_NO",
             "Target": {"Schema": "DW", "Table Name": "D_PART", "materialization": "incremental"},
             "Columns": [{"Target Column": t, "Logic": x, "Source Table": "part"} for t, x in
                         (("BRAND_CD", "p_brand"), ("PART_NO", "p_partkey"), ("SIZE_NO", "p_size"), ("PRICE", "p_retailprice"))]}
    spec = ModelSpec.from_config(sheet)
    run_models([spec], reg, store, RUN)
    dearer = spec.with_(columns=spec.columns[:3] + (C("PRICE", "p_retailprice * 2", "part"),), where="p_brand <> 'Brand#1'")
    return run_models([dearer], reg, store, RUN)["DW.D_PART"]


def q_merge_kept_key(spark, d):
    """The key declared for a table's first load stays its key when later mappings declare none, whatever their sheets say."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    spec = ModelSpec(source=TableRef("customer"), target="DW.D_CUSTOMER", materialization="incremental", unique_key=("CUST_NO",),
                     columns=(C("SEG_CD", "c_mktsegment"), C("CUST_NO", "c_custkey"), C("BAL", "c_acctbal")), where="c_acctbal < 5000")
    run_models([spec], reg, store, RUN)
    later = spec.with_(unique_key=(), sheet_key=("SEG_CD",), where="c_acctbal > 0",
                       columns=spec.columns[:2] + (C("BAL", "c_acctbal + 1"),))
    return run_models([later], reg, store, RUN)["DW.D_CUSTOMER"]


def q_schema_profile(spark, d):
    """All tables of a schema: their columns in ordinal order with row and NULL counts."""
    return schema_profile(_registry(spark, d), "testdata")


def q_conform_rules(spark, d):
    """Conforming by name with renaming rules from source to target names."""
    return conform_by_name(_registry(spark, d).source("part"), ["PART_ID", "p_name", "LIST_PRICE", "P_SIZE", "NOTE"], "DW.D_PART", RUN,
                           rules={"P_PARTKEY": "PART_ID", "p_retailprice": "LIST_PRICE"})


def q_odd_names(spark, d):
    """Target names with spaces and parentheses, kept as written."""
    spec = ModelSpec(source=TableRef("part"), target="DW.D_PART",
                     columns=(C("Part Key", "p_partkey", "part"), C("Price (USD)", "p_retailprice", "part"),
                              C("Brand-Size", "p_brand || '/' || cast(p_size as string)", "part")))
    return build_model(spec, _registry(spark, d), RUN)


def q_merge_cast_guard(spark, d):
    """Merge of a batch whose keys and numbers come in wider types: each whole value finds its row, none is changed on the way."""
    reg, store = _seed_target(spark, d)
    batch = reg.source("customer").where("c_acctbal > 0").selectExpr(
        "cast(c_custkey as decimal(20, 3)) as CUST_ID", "c_name as CUST_NM", "cast(cast(c_acctbal as decimal(12, 2)) as string) as ACCT_BAL",
        "c_mktsegment as SEG_CD", "'cast' as UPDATE_BY")
    return load_merge(store, "DW.D_CUSTOMER", batch, ["CUST_ID"])


def q_sequence_after_truncate(spark, d):
    """A numbered table truncated, loaded again and merged into: numbers go on and none comes twice."""
    store = _store(spark)
    reg = _registry(spark, d, store)
    first = SEQ_SPEC.with_(materialization="truncate_load", where="c_mktsegment = 'HOUSEHOLD'")
    run_models([first], reg, store, RUN)
    run_models([first.with_(where="c_mktsegment = 'BUILDING'")], reg, store, RUN)
    return run_models([SEQ_SPEC.with_(materialization="incremental")], reg, store, RUN)["DW.D_CUSTOMER"]


def q_stream_reset(spark, d):
    """A stream whose checkpoint is lost between two runs: the second run merges the old files again, and the new ones."""
    store = _store(spark)
    events = _registry(spark, d).source("events").withColumn("rev", F.lit(2))
    landing, checkpoint = scratch_dir(spark, "landing-reset"), scratch_dir(spark, "stream-reset")
    for rows in (events.withColumns({"value": F.lit(-1.0), "rev": F.lit(1)}), events):
        rows.write.mode("append").parquet(landing)
        stream_merge(spark, landing, events.schema, store, "RAW.EVENTS", ["event_id"], checkpoint_location=checkpoint,
                     order_by=["rev"]).awaitTermination()
        remove_path(spark, checkpoint)
    return store.read("RAW.EVENTS")


ORDER_YEAR_SPEC = ModelSpec(
    source=TableRef("orders"), target="DW.F_ORDER_YEAR", unique_key=("ORDER_ID", "ORDER_YR"),
    columns=(C("ORDER_ID", "o_orderkey", "orders"), C("CUST_ID", "o_custkey", "orders"), C("STATUS", "o_orderstatus", "orders"),
             C("AMT", "o_totalprice", "orders"), C("ORDER_YR", "year(o_orderdate)", "orders")))


def q_merge_partitions(spark, d):
    """Orders in partitions by year; corrections of the years from 1999 on rewrite these partitions only."""
    reg = _registry(spark, d)
    table = PartitionedTable(spark, scratch_dir(spark, "orders-by-year"), ["ORDER_YR"])
    table.replace(build_model(ORDER_YEAR_SPEC.with_(where="o_orderpriority <> '1-URGENT'"), reg, RUN))
    table.merge(build_model(ORDER_YEAR_SPEC.with_(where="o_orderdate >= '1999-01-01'", columns=ORDER_YEAR_SPEC.columns[:3] + (
        C("AMT", "o_totalprice * 2", "orders"),) + ORDER_YEAR_SPEC.columns[4:]), reg, RUN), ORDER_YEAR_SPEC.unique_key)
    return table.read()


def q_stream_partitions(spark, d):
    """Events streamed into partitions by type in four batches that hold every key twice: the later revision stays."""
    events = _registry(spark, d).source("events").withColumn("rev", F.lit(2))
    landing = scratch_dir(spark, "landing-partitions")
    events.union(events.withColumns({"value": F.lit(-1.0), "rev": F.lit(1)})).repartitionByRange(4, "event_id").write.parquet(landing)
    table = PartitionedTable(spark, scratch_dir(spark, "events-by-type"), ["event_type"])
    stream_partitions(spark, landing, events.schema, table, ["event_id", "event_type"], order_by=["rev"], max_files_per_trigger=1,
                      checkpoint_location=scratch_dir(spark, "stream-partitions")).awaitTermination()
    return table.read()


def q_group_sets(spark, d):
    """Grouping sets from the grouping cell's text, with the grouping's number and a condition on groups."""
    spec = ModelSpec.from_config({
        "Source": {"Type": "source", "Database": "LAKE", "Schema": "testdata", "Table Name": "customer"},
        "Target": {"Schema": "DW", "Table Name": "A_CUSTOMER"},
        "Columns": [{"Target Column": "SEG_CD", "Source Table": "customer", "Logic": "source.c_mktsegment"},
                    {"Target Column": "NATION_ID", "Source Table": "customer", "Logic": "source.c_nationkey"},
                    {"Target Column": "SET_NO", "Source Table": "customer", "Logic": "grouping_id()"},
                    {"Target Column": "CUST_CNT", "Source Table": "customer", "Logic": "count(*)"},
                    {"Target Column": "MAX_BAL", "Source Table": "customer", "Logic": "max(main.c_acctbal)"}],
        "Group By": "GROUPING SETS ((main.c_mktsegment, main.c_nationkey), (main.c_nationkey), ())", "Having": "count(*) > 10"})
    return build_model(spec, _registry(spark, d), RUN)


def q_variant_props(spark, d):
    """Fields of the events' JSON properties, parsed once per row."""
    spec = ModelSpec(
        source=TableRef("events"), target="DW.F_EVENT", derived=(("parsed", "try_parse_json(source.props)"),),
        columns=(C("EVENT_ID", "event_id", "events"), C("IS_JSON", "parsed is not null"),
                 C("K", "try_variant_get(parsed, '$.k', 'bigint')"), C("K_TEXT", "try_variant_get(parsed, '$.k', 'string')")))
    return build_model(spec, _registry(spark, d), RUN)


def q_rollup_kept(spark, d):
    """Statistics per type and user, kept up to date over four streamed batches, then rolled up to types from the states alone."""
    events = _registry(spark, d).source("events")
    landing = scratch_dir(spark, "landing-rollup")
    events.repartitionByRange(4, "ts").write.parquet(landing)
    files = len(spark.read.parquet(landing).inputFiles())  # four batches, into however many files the cluster writes
    value = "cast(value as decimal(18,4))"
    kept = Rollup(spark, scratch_dir(spark, "rollup"), ["event_type", "user_id"],
                  [Measure("EVENT_CNT", "count"), Measure("VALUE_SUM", "sum", value), Measure("VALUE_MIN", "min", "value"),
                   Measure("VALUE_MAX", "max", "value"), Measure("LAST_TS", "max", "ts")], ["event_type"])
    stream_rollup(spark, landing, events.schema, kept, max_files_per_trigger=max(1, -(-files // 4)),
                  checkpoint_location=scratch_dir(spark, "stream-rollup")).awaitTermination()
    types = kept.roll_up(["event_type"]).withColumn("user_id", F.lit(None).cast("long"))
    return kept.read().unionByName(types).withColumn("VALUE_SUM", F.col("VALUE_SUM").cast("double"))


def q_stream_sessions(spark, d):
    """Final sessions per user (an hour's gap) of events that were delivered twice, in eight batches."""
    events = _registry(spark, d).source("events")
    landing, out = scratch_dir(spark, "landing-sessions"), scratch_dir(spark, "sessions")
    events.union(events).repartitionByRange(8, "ts").sortWithinPartitions("ts").write.parquet(landing)
    stream_windows(spark, landing, events.schema, out, scratch_dir(spark, "stream-sessions"), "ts", "1 day", ["user_id"],
                   [F.count(F.lit(1)).alias("event_cnt"), F.sum("event_id").alias("event_sum"), F.max("value").alias("value_max")],
                   gap="1 hour", unique_by=["event_id"]).awaitTermination()
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return spark.read.parquet(out).withColumns(ends)


def q_stream_windows(spark, d):
    """Final six-hour windows per type, one every three hours, over events in eight batches."""
    events = _registry(spark, d).source("events")
    landing, out = scratch_dir(spark, "landing-windows"), scratch_dir(spark, "windows")
    events.repartitionByRange(8, "ts").write.parquet(landing)
    stream_windows(spark, landing, events.schema, out, scratch_dir(spark, "stream-windows"), "ts", "1 day", ["event_type"],
                   [F.count(F.lit(1)).alias("event_cnt"), F.max("value").alias("value_max")],
                   duration="6 hours", slide="3 hours").awaitTermination()
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return spark.read.parquet(out).withColumns(ends)


KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def q_key_discovery(spark, d):
    """Minimal unique column sets of the order lines, up to three columns."""
    found = discover_keys(_registry(spark, d).source("lineitem"), KEY_COLUMNS)
    return spark.createDataFrame([(",".join(k), len(k)) for k in found], "KEY_COLUMNS string, KEY_SIZE int")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer_dimension": q_customer_dimension,
    "scan_source": q_scan_source,
    "scan_ref": q_scan_ref,
    "catalog_columns_sorted": q_catalog_columns_sorted,
    "project_logic": q_project_logic,
    "project_ddl_order": q_project_ddl_order,
    "audit_stamp": q_audit_stamp,
    "filter_where": q_filter_where,
    "join_left_chain": q_join_left_chain,
    "join_inner": q_join_inner,
    "join_theta": q_join_theta,
    "join_left_split": q_join_left_split,
    "join_right": q_join_right,
    "join_full": q_join_full,
    "group_by": q_group_by,
    "group_rollup": q_group_rollup,
    "group_lineitem": q_group_lineitem,
    "aggregate_global": q_aggregate_global,
    "delta_minus": q_delta_minus,
    "load_truncate": q_load_truncate,
    "load_append": q_load_append,
    "merge_update_columns": q_merge_update_columns,
    "merge_all_columns": q_merge_all_columns,
    "insert_by_name": q_insert_by_name,
    "surrogate_key": q_surrogate_key,
    "conform_automap": q_conform_automap,
    "landing_load": q_landing_load,
    "view_positional": q_view_positional,
    "recon_except": q_recon_except,
    "recon_counts": q_recon_counts,
    "recon_empty_probe": q_recon_empty_probe,
    "duplicate_keys": q_duplicate_keys,
    "model_graph": q_model_graph,
    "stream_merge": q_stream_merge,
    "view_lasting": q_view_lasting,
    "delta_truncate_load": q_delta_truncate_load,
    "delta_mixed_types": q_delta_mixed_types,
    "join_expr_equi": q_join_expr_equi,
    "merge_with_sequence": q_merge_with_sequence,
    "insert_with_sequence": q_insert_with_sequence,
    "merge_orders": q_merge_orders,
    "insert_select_joined": q_insert_select_joined,
    "job_steps": q_job_steps,
    "group_by_config": q_group_by_config,
    "merge_chosen_key": q_merge_chosen_key,
    "merge_sheet_key": q_merge_sheet_key,
    "merge_kept_key": q_merge_kept_key,
    "schema_profile": q_schema_profile,
    "conform_rules": q_conform_rules,
    "odd_names": q_odd_names,
    "column_profile": q_column_profile,
    "join_interval": q_join_interval,
    "join_interval_full": q_join_interval_full,
    "join_disjunction": q_join_disjunction,
    "join_asof": q_join_asof,
    "window_hot": q_window_hot,
    "recon_digest": q_recon_digest,
    "merge_cast_guard": q_merge_cast_guard,
    "sequence_after_truncate": q_sequence_after_truncate,
    "stream_reset": q_stream_reset,
    "merge_partitions": q_merge_partitions,
    "stream_partitions": q_stream_partitions,
    "group_sets": q_group_sets,
    "variant_props": q_variant_props,
    "key_discovery": q_key_discovery,
    "rollup_kept": q_rollup_kept,
    "stream_sessions": q_stream_sessions,
    "stream_windows": q_stream_windows,
}


def _text_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """The text operators' queries and SQL; empty without their subpackage or the pipeline beside it."""
    try:
        import corpus_pipeline
        from mapflow.llm import queries as text
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "mapflow.llm", "mapflow.llm.queries"):
            raise
        return {}, {}
    sql = dict(text.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**text.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_text_queries()[0]}


# --- oracle SQL --------------------------------------------------------------------

_SRC = ("select c_custkey as CUST_ID, c_name as CUST_NM, c_acctbal as ACCT_BAL, c_mktsegment as SEG_CD "
        "from customer")
_TGT = ("select c_custkey as CUST_ID, c_name as CUST_NM, "
        "case when c_nationkey = 7 then 0.0 else c_acctbal end as ACCT_BAL, c_mktsegment as SEG_CD, "
        "'old' as CREATE_BY, 'old' as UPDATE_BY from customer where c_mktsegment <> 'HOUSEHOLD'")
_CHG = (f"(select CUST_ID, CUST_NM, ACCT_BAL, SEG_CD from ({_SRC}) s) "
        f"except (select CUST_ID, CUST_NM, ACCT_BAL, SEG_CD from ({_TGT}) t)")


def _merge_sql(create_by_from_source: bool) -> str:
    create_by = ("case when c.CUST_ID is not null then 'new' else t.CREATE_BY end" if create_by_from_source
                 else "case when t.CUST_ID is null then 'new' else t.CREATE_BY end")
    return (
        f"with t as ({_TGT}), c as ({_CHG}) "
        "select coalesce(t.CUST_ID, c.CUST_ID) as CUST_ID, "
        "case when c.CUST_ID is not null then c.CUST_NM else t.CUST_NM end as CUST_NM, "
        "case when c.CUST_ID is not null then c.ACCT_BAL else t.ACCT_BAL end as ACCT_BAL, "
        "case when c.CUST_ID is not null then c.SEG_CD else t.SEG_CD end as SEG_CD, "
        f"{create_by} as CREATE_BY, "
        "case when c.CUST_ID is not null then 'new' else t.UPDATE_BY end as UPDATE_BY "
        "from t full outer join c on t.CUST_ID = c.CUST_ID")


_NEW = f"select * from ({_SRC}) s where not exists (select 1 from ({_TGT}) t where t.CUST_ID = s.CUST_ID)"

_SUPPLIER_NATION = (
    "select source.s_suppkey as SUPP_ID, n.n_nationkey as NATION_ID, n.n_name as NATION_NM "
    "from supplier source {how} join nation n on source.s_nationkey = n.n_nationkey and source.s_acctbal > 5000")

def _key_sql() -> str:
    """Unique sets of KEY_COLUMNS that hold no smaller one."""
    tried = [c for n in (1, 2, 3) for c in itertools.combinations(KEY_COLUMNS, n)]
    parts = " union all ".join(
        f"select '{','.join(c)}' as k, [{', '.join(repr(x) for x in c)}] as cols, {len(c)} as n, "
        f"count(*) = count(distinct ({', '.join(c)})) and count(*) = {' and count(*) = '.join(f'count({x})' for x in c)} as uniq from lineitem" for c in tried)
    return (f"with t as ({parts}) select k as KEY_COLUMNS, n as KEY_SIZE from t where uniq and not exists ("
            "select 1 from t s where s.uniq and s.n < t.n and list_has_all(t.cols, s.cols))")


def _schema_sql() -> str:
    """Row and NULL counts of every column of every table, in the catalog's order."""
    counts = " union all ".join(
        f"select '{t}' as t, name, rows, value from (unpivot (select count(*) as rows, count(columns(*)) from {t}) "
        "on columns(* exclude rows))" for t in TABLES)
    return (f"with c as ({counts}) select 'TESTDATA' as TABLE_SCHEMA, upper(t) as TABLE_NAME, cast(ordinal_position as int) as ORDINAL_POSITION, "
            "name as COLUMN_NAME, rows as ROW_CNT, rows - value as NULL_CNT from c join information_schema.columns on table_name = t and column_name = name")


_ORACLE = {
    "customer_dimension": (
        "select source.c_custkey as CUST_ID, upper(source.c_name) as CUST_NM, n.n_name as NATION_NM, "
        "r.r_name as REGION_NM, case when source.c_acctbal > 5000 then 'HIGH' else 'STD' end as BAL_TIER, "
        "source.c_mktsegment || '/' || n.n_name as SEG_NATION, 'DW.D_CUSTOMER' as DATA_SRC, "
        "timestamp '2024-01-01 00:00:00' as CREATE_DT, 'tester' as CREATE_BY "
        "from customer source left join nation n on source.c_nationkey = n.n_nationkey "
        "left join region r on n.n_regionkey = r.r_regionkey where source.c_acctbal > 0"),
    "scan_source": "select * from supplier",
    "scan_ref": f"select CUST_ID, ACCT_BAL from ({_SRC}) m where ACCT_BAL > 0",
    "catalog_columns_sorted": (
        "select column_name as COLUMN_NAME, ordinal_position as ORDINAL_POSITION from information_schema.columns "
        "where table_name = 'customer' order by ordinal_position"),
    "project_logic": (
        "select c_custkey as CUST_ID, upper(c_name) as CUST_NM, case when c_acctbal < 0 then 'N' else 'P' end as "
        "BAL_FLG, c_mktsegment || '-' || cast(c_nationkey as varchar(200)) as SEG_NATION, c_acctbal * 2 + 1 as BAL2, "
        "'DW.D_CUSTOMER' as DATA_SRC, '' as UNMAPPED from customer"),
    "project_ddl_order": (
        "select c_mktsegment as SEG_CD, c_custkey as CUST_ID, c_acctbal as ACCT_BAL, c_name as CUST_NM from customer"),
    "audit_stamp": (
        "select c_custkey as CUST_ID, 'DW.D_CUSTOMER' as DATA_SRC, timestamp '2024-01-01 00:00:00' as CREATE_DT, "
        "'tester' as CREATE_BY, 'DW.D_CUSTOMER' as CREATE_PGM, timestamp '2024-01-01 00:00:00' as UPDATE_DT, "
        "'tester' as UPDATE_BY, 'DW.D_CUSTOMER' as UPDATE_PGM from customer"),
    "filter_where": (
        "select o_orderkey as ORDER_ID, o_totalprice as AMT from orders source "
        "where source.o_orderstatus = 'F' and source.o_totalprice > 100000"),
    "join_left_chain": (
        "select source.c_custkey as CUST_ID, n.n_name as NATION_NM, r.r_name as REGION_NM from customer source "
        "left join nation n on source.c_nationkey = n.n_nationkey and n.n_nationkey < 20 "
        "left join region r on n.n_regionkey = r.r_regionkey"),
    "join_inner": (
        "select source.o_orderkey as ORDER_ID, c.c_name as CUST_NM from orders source "
        "inner join customer c on source.o_custkey = c.c_custkey where c.c_acctbal > 0"),
    "join_theta": (
        "select source.s_suppkey as SUPP_ID, n.n_nationkey as NATION_ID from supplier source "
        "left join nation n on source.s_nationkey > n.n_nationkey and source.s_acctbal > 0"),
    "join_left_split": (
        "select source.c_custkey as CUST_ID, o.o_orderkey as ORDER_ID, o.o_totalprice as AMT from customer source "
        "left join orders o on source.c_custkey = o.o_custkey"),
    "join_right": _SUPPLIER_NATION.format(how="right"),
    "join_full": _SUPPLIER_NATION.format(how="full outer"),
    "group_by": (
        "select source.o_custkey as CUST_ID, count(*) as ORDER_CNT, max(source.o_totalprice) as MAX_AMT, "
        "count(distinct source.o_orderpriority) as PRI_CNT from orders source where source.o_orderstatus = 'F' "
        "group by source.o_custkey"),
    "group_rollup": (
        "select c_mktsegment as SEG_CD, c_nationkey as NATION_ID, count(*) as CUST_CNT, max(c_acctbal) as MAX_BAL "
        "from customer group by rollup(c_mktsegment, c_nationkey)"),
    "group_lineitem": (
        "select source.l_returnflag as RETURN_FLG, o.o_orderstatus as ORDER_STATUS, count(*) as LINE_CNT, "
        "max(source.l_extendedprice) as MAX_PRICE, count(distinct source.l_suppkey) as SUPP_CNT "
        "from lineitem source inner join orders o on source.l_orderkey = o.o_orderkey "
        "group by source.l_returnflag, o.o_orderstatus"),
    "aggregate_global": "select count(*) as ORDER_CNT, max(o_totalprice) as MAX_AMT from orders",
    "delta_minus": f"select 'DW.D_CUSTOMER' as DATA_SRC, d.* from ({_CHG}) d",
    "load_truncate": _SRC,
    "load_append": (
        f"select CUST_ID, CUST_NM from ({_TGT}) t union all select CUST_ID, CUST_NM from ({_SRC}) s"),
    "merge_update_columns": _merge_sql(create_by_from_source=False),
    "merge_all_columns": _merge_sql(create_by_from_source=True),
    "insert_by_name": (
        f"select CUST_ID, CUST_NM, ACCT_BAL, SEG_CD, CREATE_BY, UPDATE_BY from ({_TGT}) t union all "
        "select CUST_ID, CUST_NM, cast(null as double) as ACCT_BAL, SEG_CD, cast(null as varchar) as CREATE_BY, "
        f"cast(null as varchar) as UPDATE_BY from ({_NEW}) n"),
    "surrogate_key": (
        f"select CUST_ID, CUST_NM, (select max(CUST_ID) from ({_TGT}) m) + row_number() over (order by CUST_ID) "
        f"as CUST_SK from ({_NEW}) n"),
    "conform_automap": (
        "select s_suppkey as S_SUPPKEY, s_name as S_NAME, '' as S_COUNTRY, 'DW.D_SUPPLIER' as DATA_SRC from supplier"),
    "landing_load": "select *, 'testdata.supplier' as DATA_SRC from supplier",
    "view_positional": (
        "select s_suppkey as SUPP_ID, s_name as SUPP_NM, s_nationkey as NATION_ID, s_acctbal as BAL from supplier"),
    "recon_except": (
        f"(select * from ({_TGT}) t) except (select c_custkey, c_name, c_acctbal, c_mktsegment, 'old', 'old' from customer)"),
    "recon_counts": (
        f"select (select count(*) from ({_TGT}) t) as TARGET_CNT, (select count(*) from ({_SRC}) s) as SOURCE_CNT"),
    "recon_empty_probe": f"select * from ({_TGT}) t where 1=0",
    "duplicate_keys": (
        "select l_orderkey as ORDER_ID, count(*) as DUP_CNT from lineitem group by l_orderkey having count(*) > 1"),
    "model_graph": f"select SEG_CD, count(*) as CUST_CNT, max(ACCT_BAL) as MAX_BAL from ({_SRC}) d group by SEG_CD",
    "stream_merge": (
        "select event_id as EVENT_ID, ts as TS, user_id as USER_ID, event_type as EVENT_TYPE, value as VALUE, props as PROPS, "
        "2 as REV from events"),
    "view_lasting": (
        "select s_suppkey as SUPP_ID, s_name as SUPP_NM, s_nationkey as NATION_ID, s_acctbal as BAL from supplier"),
    "delta_truncate_load": _SRC,
    "delta_mixed_types": (
        "select c_custkey as CUST_ID, cast(c_nationkey as double) as NATION_ID from customer where c_mktsegment = 'BUILDING'"),
    "join_expr_equi": (
        "select o_orderkey as ORDER_ID, c.c_name as CUST_NM from orders source left join customer c "
        "on upper(cast(source.o_custkey as varchar)) = trim(cast(c.c_custkey as varchar)) and c.c_acctbal > 0"),
    "merge_with_sequence": (
        f"with t as (select CUST_ID, row_number() over (order by CUST_ID) as SK from ({_TGT}) a), s as ({_SRC}) "
        "select coalesce(t.SK, (select max(SK) from t) + row_number() over (partition by t.SK is null order by s.CUST_ID)) as CUST_SK, "
        "s.* from s left join t on s.CUST_ID = t.CUST_ID"),
    "insert_with_sequence": (
        f"with t as (select row_number() over (order by CUST_ID) as CUST_SK, CUST_ID, CUST_NM, ACCT_BAL, SEG_CD from ({_TGT}) a) "
        "select * from t union all select (select max(CUST_SK) from t) + row_number() over (order by CUST_ID), s.* "
        f"from ({_SRC}) s where SEG_CD = 'HOUSEHOLD'"),
    "merge_orders": (
        "select o_orderkey as ORDER_ID, o_custkey as CUST_ID, o_orderstatus as STATUS, "
        "case when o_custkey = 7 then o_totalprice * 2 else o_totalprice end as AMT, o_orderdate as ORDER_DT, "
        "o_orderpriority as PRIO from orders"),
    "insert_select_joined": (
        "select n_name as NATION_NM, cast(0 as bigint) as ORDER_CNT, n_regionkey as REGION_ID from nation union all "
        "select n.n_name, count(*), null from orders source join customer c on o_custkey = c.c_custkey "
        "join nation n on c.c_nationkey = n.n_nationkey where o_orderstatus = 'F' group by n.n_name"),
    "job_steps": (
        "select p_partkey as PART_ID, p_name as PART_NM, p_retailprice as PRICE from part union all "
        "select p_partkey, p_name, p_retailprice from part"),
    "group_by_config": (
        "select p_brand as BRAND, coalesce(p_size % 5, -1) as SIZE_CD, count(*) as PART_CNT, max(p_retailprice) as MAX_PRICE "
        "from part group by 1, 2"),
    "merge_chosen_key": (
        "select p_name as PART_NM, p_partkey as PART_ID, case when p_size > 25 then p_retailprice + 1 else p_retailprice end as PRICE "
        "from part"),
    "merge_sheet_key": (
        "select p_brand as BRAND_CD, p_partkey as PART_NO, p_size as SIZE_NO, "
        "case when p_brand <> 'Brand#1' then p_retailprice * 2 else p_retailprice end as PRICE from part"),
    "merge_kept_key": (
        "select c_mktsegment as SEG_CD, c_custkey as CUST_NO, case when c_acctbal > 0 then c_acctbal + 1 else c_acctbal end as BAL "
        "from customer where c_acctbal > 0 or c_acctbal < 5000"),
    "schema_profile": _schema_sql(),
    "conform_rules": (
        "select p_partkey as PART_ID, p_name as p_name, p_retailprice as LIST_PRICE, p_size as P_SIZE, '' as NOTE from part"),
    "column_profile": (
        "with j as (select * from orders left join customer on o_custkey = c_custkey and c_acctbal > 0) "
        + " union all ".join(f"select {i} as ORDINAL_POSITION, '{c}' as COLUMN_NAME, count(*) as ROW_CNT, count(*) - count({c}) as NULL_CNT from j"
                             for i, c in enumerate(("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment"), 1))),
    "join_interval": (
        "select o_orderkey as ORDER_ID, l.l_orderkey as LINE_ORDER_ID, l.l_linenumber as LINE_NO from orders source left join lineitem l "
        "on source.o_totalprice >= l.l_extendedprice and source.o_totalprice < l.l_extendedprice + 1 and l.l_quantity > 5"),
    "join_interval_full": (
        "select l_orderkey as LINE_ORDER_ID, l_linenumber as LINE_NO, o.o_orderkey as ORDER_ID from lineitem source full outer join orders o "
        "on source.l_extendedprice <= o.o_totalprice + 0.4 and source.l_extendedprice + 0.6 >= o.o_totalprice"),
    "join_disjunction": (
        "with f as (select * from orders where o_orderstatus = 'F'), m as ("
        "select l_orderkey, l_linenumber, l_partkey, o_orderkey from lineitem join f on l_orderkey = o_orderkey union all "
        "select l_orderkey, l_linenumber, l_partkey, o_orderkey from lineitem join orders on l_partkey = o_orderkey "
        "where not (l_orderkey = o_orderkey and o_orderstatus = 'F')) "
        "select l_orderkey as LINE_ORDER_ID, l_linenumber as LINE_NO, l_partkey as PART_ID, o_orderkey as ORDER_ID from m union all "
        "select l_orderkey, l_linenumber, l_partkey, null from lineitem where l_orderkey not in (select o_orderkey from f) "
        "and l_partkey not in (select o_orderkey from orders) union all "
        "select null, null, null, o_orderkey from orders where o_orderkey not in (select o_orderkey from m)"),
    "join_asof": (
        "with v as (select user_id, ts, max(event_id) as event_id from events where event_type = 'view' group by user_id, ts) "
        "select e.event_id, e.user_id, e.event_type, e.ts, if(v.ts >= e.ts - interval 5 days, v.event_id, null) as view_id, "
        "if(v.ts >= e.ts - interval 5 days, v.ts, null) as view_ts from events e asof left join v on e.user_id = v.user_id and e.ts > v.ts"),
    "window_hot": (
        "select event_id, event_type, user_id, ts, row_number() over w as row_no, lag(event_id) over w as previous_id, "
        "cast(sum(user_id) over w as bigint) as user_sum, max(user_id) over w as user_max, min(user_id) over w as user_min "
        "from events window w as (partition by event_type order by ts, event_id)"),
    "recon_digest": (
        f"select 'target' as DIFF_SIDE, t.* from ((select CUST_ID, CUST_NM, ACCT_BAL, SEG_CD from ({_TGT}) a) except ({_SRC})) t union all "
        f"select 'source' as DIFF_SIDE, s.* from (({_SRC}) except (select CUST_ID, CUST_NM, ACCT_BAL, SEG_CD from ({_TGT}) a)) s"),
    "merge_cast_guard": (
        f"with t as ({_TGT}), s as (select c_custkey as CUST_ID, c_name as CUST_NM, c_acctbal as ACCT_BAL, c_mktsegment as SEG_CD "
        "from customer where c_acctbal > 0) "
        "select coalesce(t.CUST_ID, s.CUST_ID) as CUST_ID, coalesce(s.CUST_NM, t.CUST_NM) as CUST_NM, coalesce(s.ACCT_BAL, t.ACCT_BAL) as ACCT_BAL, "
        "coalesce(s.SEG_CD, t.SEG_CD) as SEG_CD, t.CREATE_BY, if(s.CUST_ID is null, t.UPDATE_BY, 'cast') as UPDATE_BY "
        "from t full outer join s on t.CUST_ID = s.CUST_ID"),
    "sequence_after_truncate": (
        f"with s as ({_SRC}), n as (select (select count(*) from s where SEG_CD = 'HOUSEHOLD') as h, "
        "(select count(*) from s where SEG_CD = 'BUILDING') as b) "
        "select if(SEG_CD = 'BUILDING', h, h + b) + row_number() over (partition by SEG_CD = 'BUILDING' order by CUST_ID) as CUST_SK, s.* from s, n"),
    "stream_reset": "select *, 2 as rev from events",
    "merge_partitions": (
        "select o_orderkey as ORDER_ID, o_custkey as CUST_ID, o_orderstatus as STATUS, if(year(o_orderdate) >= 1999, o_totalprice * 2, o_totalprice) as AMT, "
        "cast(year(o_orderdate) as integer) as ORDER_YR from orders where o_orderpriority <> '1-URGENT' or year(o_orderdate) >= 1999"),
    "stream_partitions": "select *, 2 as rev from events",
    "rollup_kept": (
        "select event_type, user_id, count(*) as EVENT_CNT, cast(sum(cast(value as decimal(18,4))) as double) as VALUE_SUM, "
        "min(value) as VALUE_MIN, max(value) as VALUE_MAX, max(ts) as LAST_TS from events "
        "group by grouping sets ((event_type, user_id), (event_type))"),
    "stream_sessions": (
        "with g as (select *, if(ts - lag(ts) over w <= interval 1 hour, 0, 1) as begins from events "
        "window w as (partition by user_id order by ts, event_id)), "
        "n as (select *, sum(begins) over (partition by user_id order by ts, event_id) as session from g) "
        "select user_id, min(ts) as window_start, max(ts) + interval 1 hour as window_end, count(*) as event_cnt, "
        "cast(sum(event_id) as bigint) as event_sum, max(value) as value_max from n group by user_id, session "
        "having max(ts) + interval 1 hour <= (select date_trunc('milliseconds', max(ts)) - interval 1 day from events)"),
    "stream_windows": (
        "with s as (select event_type, value, time_bucket(interval 3 hours, ts) - to_hours(3 * k) as window_start "
        "from events, (values (0), (1)) v(k)) "
        "select window_start, window_start + interval 6 hours as window_end, event_type, count(*) as event_cnt, max(value) as value_max "
        "from s group by window_start, event_type "
        "having window_start + interval 6 hours <= (select date_trunc('milliseconds', max(ts)) - interval 1 day from events)"),
    "group_sets": (
        "select c_mktsegment as SEG_CD, c_nationkey as NATION_ID, cast(grouping_id(c_mktsegment, c_nationkey) as bigint) as SET_NO, "
        "count(*) as CUST_CNT, max(c_acctbal) as MAX_BAL from customer "
        "group by grouping sets ((c_mktsegment, c_nationkey), (c_nationkey), ()) having count(*) > 10"),
    "variant_props": (
        "select event_id as EVENT_ID, json_valid(props) as IS_JSON, cast(json_extract_string(props, '$.k') as bigint) as K, "
        "json_extract_string(props, '$.k') as K_TEXT from events"),
    "key_discovery": _key_sql(),
    "odd_names": (
        "select p_partkey as \"Part Key\", p_retailprice as \"Price (USD)\", p_brand || '/' || cast(p_size as varchar) as "
        "\"Brand-Size\" from part"),
}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLE, **_text_queries()[1]}
