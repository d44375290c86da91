"""Logistics inputs derived by Spark from the driver's TPC-H-like tables.

The test tables carry no freight data, so the registered queries derive it: every derived
table is a projection / join of a driver table, so its size grows with the scale factor.

* departments  = nations, code ``N00`` … ``N24``; province = region; center = region 0 or 1
* line timetable = suppliers: a supplier of nation ``n`` runs a daily line
  ``n -> n + 1 + suppkey % 3`` (trunk, branch or partner by ``suppkey % 3``)
* waybills     = orders, with a planned route over nations starting at the customer's nation
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.clean import CLEAN_SPECS, CleanSpec


N_NATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dept_code(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("N"), F.lpad(c.cast("string"), 2, "0"))


def supplier_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trunk, branch, partner) line tables with raw text leave times (some NULL spellings and
    unpadded ``H:mm`` texts included)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    hour, minute = (k * 7) % 24, (k % 2) * 30
    text = (F.when(k % 11 == 0, F.lit("NULL")).when(k % 17 == 0, F.lit(""))
            .when(k % 4 == 0, F.format_string("%d:%02d", hour.cast("int"), minute.cast("int")))
            .otherwise(F.format_string("%02d:%02d:00", hour.cast("int"), minute.cast("int"))))
    base = s.select(
        dept_code("s_nationkey").alias("leave_department_code"),
        dept_code((F.col("s_nationkey") + 1 + k % 3) % N_NATIONS).alias("arrive_department_code"),
        text.alias("leave_time"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(60 + 30 * (k % 5)).cast("long").alias("run_minutes"),
        (k % 4).cast("long").alias("unload_time"),
        (k % 3).alias("kind"),
        F.when(k % 7 == 0, F.lit("airplane")).otherwise(F.lit("car")).alias("branch_type"))
    trunk = base.filter(F.col("kind") == 0).withColumn("type", F.lit("trunk")).drop("kind", "branch_type")
    branch = base.filter(F.col("kind") == 1).withColumn("type", F.col("branch_type")).drop("kind", "branch_type")
    partner = base.filter(F.col("kind") == 2).drop("kind", "branch_type")
    return trunk, branch, partner


def order_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as waybills: ``route`` text ``N05:0-N07:1-…`` of 2..6 stops stepping 1..3 nations
    from the customer's nation (every 7th order returns to its first stop), ``current`` stop
    (absent for every 11th order), ``status`` from the order status, ``leave_org`` and ready
    time ``t0``."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    key = F.col("o_orderkey")
    size = (key % 5 + 2).cast("int")
    step = (key % 3 + 1).cast("int")
    nat = F.col("c_nationkey")
    max_stops = 6
    stop_codes = [dept_code(F.when((key % 7 == 0) & (F.lit(i) == size - 1), nat)
                            .otherwise((nat + i * step) % N_NATIONS)) for i in range(max_stops)]
    codes = F.slice(F.array(*stop_codes), 1, size)
    route = F.concat_ws("-", *[F.when(F.lit(i) < size, F.concat(c, F.lit(":" + str(i))))
                               for i, c in enumerate(stop_codes)])
    current = F.when(key % 11 == 0, F.lit("N99")).otherwise(F.element_at(codes, (key % size).cast("int") + 1))
    status = (F.when(F.col("o_orderstatus") == "O", F.lit("load_noarrive"))
              .when(F.col("o_orderstatus") == "F", F.lit("load_arriveed")).otherwise(F.lit("stock")))
    t0 = F.timestamp_add("MINUTE", (key * 7) % 60, F.timestamp_add("HOUR", key % 24, F.col("o_orderdate")))
    return (j.withColumn("__codes", codes)
            .select("o_orderkey", "c_nationkey", route.alias("route"), current.alias("current"),
                    status.alias("status"), dept_code((nat + 24) % N_NATIONS).alias("leave_org"),
                    t0.cast("timestamp_ntz").alias("t0")))


def _ts_plus(ts: Column, hours=None, minutes=None) -> Column:
    out = ts
    if hours is not None:
        out = F.timestamp_add("HOUR", hours, out)
    if minutes is not None:
        out = F.timestamp_add("MINUTE", minutes, out)
    return out.cast("timestamp_ntz")


def _item(orderkey: Column, linenumber: Column) -> Column:
    """What a scan names: the bag of the order for every 4th line, else the waybill itself."""
    return F.when(linenumber % 4 == 1, F.concat(F.lit("B"), (orderkey / 8).cast("long").cast("string"))) \
        .otherwise(F.concat(F.lit("W"), orderkey.cast("string")))


def logistics_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw operational tables (before cleaning) derived from the driver tables."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    line_id = (ok * 10 + ln).cast("string")
    line_dept = dept_code((F.col("l_suppkey") + ln) % N_NATIONS)
    wb = F.concat(F.lit("W"), F.col("o_orderkey").cast("string"))
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")

    basic = s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner").select(
        dept_code("s_nationkey").alias("code"),
        F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("prov_code"),
        F.when((F.col("n_regionkey") <= 2) & (F.col("s_suppkey") % 5 != 0), F.lit("Y")).otherwise(F.lit("N")).alias("center"),
        F.when(F.col("s_suppkey") % 9 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"),
        _ts_plus(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), minutes=F.col("s_suppkey")).alias("create_time"))

    box = o.select(
        F.col("o_orderkey").cast("string").alias("id"), wb.alias("waybill_number"),
        F.concat(F.lit("B"), (F.col("o_orderkey") / 8).cast("long").cast("string")).alias("task_number"),
        (F.col("o_totalprice") / 100).alias("waybill_weight"), (F.col("o_totalprice") / 1000).alias("waybill_volume"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("0")).otherwise(F.lit("1")).alias("valid_status"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    unload = li.select(
        line_id.alias("id"), _item(ok, ln).alias("waybill_number"),
        F.concat(F.lit("A"), ok.cast("string")).alias("assignment_number"),
        line_dept.alias("now_department_code"),
        F.when(ln % 3 == 0, F.lit("PC")).when(ln % 3 == 1, F.lit("PDA")).otherwise(F.lit("GUN")).alias("device_type"),
        F.lit("1").alias("is_active"),
        _ts_plus(F.col("l_shipdate"), hours=ln).alias("create_time"),
        _ts_plus(F.col("l_shipdate"), minutes=F.col("l_partkey") % 1000).alias("inflow_time"))

    load_detail = li.filter(F.col("l_linestatus") == "O").select(
        line_id.alias("id"), _item(ok, ln).alias("waybill_number"),
        F.concat(F.lit("A"), ok.cast("string")).alias("assignment_number"),
        F.when(F.col("l_partkey") % 3 != 0, line_dept)
         .otherwise(dept_code((F.col("l_suppkey") + ln + 1) % N_NATIONS)).alias("leave_department_code"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit("PC")).otherwise(F.lit("PDA")).alias("device_type"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit("0")).otherwise(F.lit("1")).alias("is_active"),
        _ts_plus(F.col("l_shipdate"), hours=ln + 2).alias("create_time"),
        _ts_plus(F.col("l_shipdate"), hours=ln + 2).alias("inflow_time"))

    sign = o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0)).select(
        F.col("o_orderkey").cast("string").alias("id"), wb.alias("waybill_number"),
        F.timestamp_add("DAY", F.lit(5), F.col("o_orderdate")).cast("timestamp_ntz").alias("sign_time"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    stock = li.select(
        line_id.alias("id"), F.concat(F.lit("W"), ok.cast("string")).alias("waybill_number"),
        line_dept.alias("department_code"),
        _ts_plus(F.col("l_shipdate"), hours=ln * 3).alias("stock_time"),
        _ts_plus(F.col("l_shipdate"), hours=ln * 3).alias("create_time"),
        F.when(ok % 10 == 0, F.lit("BAG")).otherwise(F.lit("WAYBILL")).alias("waybill_type"),
        _ts_plus(F.col("l_shipdate"), hours=ln * 3).alias("inflow_time"))

    pallet = li.filter(F.col("l_returnflag") == "A").select(
        _item(ok, ln).alias("waybill_number"), line_dept.alias("org_code"),
        _ts_plus(F.col("l_shipdate"), hours=ln + 1).alias("create_time"))

    scan = li.filter(F.col("l_returnflag") == "R").select(
        _item(ok, ln).alias("waybill_number"), line_dept.alias("operation_org_code"),
        _ts_plus(F.col("l_shipdate"), hours=ln, minutes=F.lit(30)).alias("create_time"))

    routes = order_routes(spark, sf_dir)
    path = routes.select(F.col("o_orderkey").cast("string").alias("id"),
                         F.concat(F.lit("W"), F.col("o_orderkey").cast("string")).alias("waybill_number"),
                         F.col("route").alias("waybill_route_codes"),
                         F.col("t0").alias("create_time"), F.col("t0").alias("inflow_time"))

    # Every 41st waybill has a second path record with the same route, every 43rd one with another.
    again = F.col("id").cast("long")
    path = path.unionByName(path.filter(again % 41 == 0).withColumn("id", (again + 100_000_000).cast("string"))) \
        .unionByName(path.filter(again % 43 == 0).withColumn("id", (again + 200_000_000).cast("string"))
                     .withColumn("waybill_route_codes", F.regexp_replace("waybill_route_codes", "^[^-]*-", "")))

    k = F.col("o_orderkey")
    waybill = oc.select(
        k.cast("string").alias("id"), wb.alias("waybill_number"),
        (k % 5 + 1).cast("double").alias("goods_qty"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 1000).alias("goods_volume"),
        F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 100).alias("goods_weight"),
        dept_code("c_nationkey").alias("billing_department_code"),
        dept_code("c_nationkey").alias("receive_department_code"),
        dept_code((F.col("c_nationkey") + 3) % N_NATIONS).alias("customer_pickup_department_code"),
        F.col("o_orderdate").alias("bill_time"),
        F.when(k % 50 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    # Every 37th waybill has a second active record.
    waybill = waybill.unionByName(
        waybill.filter(again % 37 == 0).withColumn("id", (again + 100_000_000).cast("string"))
        .withColumn("goods_qty", F.col("goods_qty") + F.lit(1.0)))

    hop = (k % 3 + 1)
    load = oc.select(
        k.cast("string").alias("id"), F.concat(F.lit("A"), k.cast("string")).alias("assignment_number"),
        dept_code("c_nationkey").alias("leave_department_code"),
        dept_code((F.col("c_nationkey") + hop) % N_NATIONS).alias("arrive_department_code"),
        F.when(k % 29 == 0, F.lit("0")).otherwise(F.lit("1")).alias("is_active"),
        _ts_plus(F.col("o_orderdate"), hours=F.lit(6)).alias("end_time"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    traffic = o.select(
        k.cast("string").alias("id"), F.concat(F.lit("A"), k.cast("string")).alias("assignment_number"),
        F.concat(F.lit("T"), k.cast("string")).alias("transport_task_id"), F.lit("Y").alias("is_active"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    leave_at = _ts_plus(F.col("o_orderdate"), hours=k % 24)
    traffic_detail = o.select(
        F.concat(F.lit("T"), k.cast("string")).alias("transport_task_id"),
        F.concat(F.lit("C"), (k % 97).cast("string")).alias("car_number"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(leave_at).cast("timestamp_ntz").alias("actual_leave_department_time"),
        F.when(k % 4 <= 1, F.lit(None)).otherwise(_ts_plus(leave_at, hours=F.lit(5))).cast("timestamp_ntz")
         .alias("actual_arrive_department_time"),
        F.when(k % 31 == 0, F.lit(None)).otherwise(_ts_plus(leave_at, hours=hop * 4)).cast("timestamp_ntz")
         .alias("plan_arrive_department_time"),
        F.when(k % 17 == 0, F.lit("CANCLE")).otherwise(F.lit("NORMAL")).alias("transport_task_status"),
        F.lit("Y").alias("is_active"),
        F.col("o_orderdate").alias("create_time"), F.col("o_orderdate").alias("inflow_time"))

    prov = F.concat(F.lit("P"), F.col("r_regionkey").cast("string"))
    same_day = r.select(prov.alias("leave_province_code"), prov.alias("arrive_province_code"),
                        F.lit("Y").alias("equal_province")) \
        .unionByName(r.select(prov.alias("leave_province_code"),
                              F.concat(F.lit("P"), ((F.col("r_regionkey") + 1) % 5).cast("string"))
                              .alias("arrive_province_code"), F.lit("N").alias("equal_province")))

    trunk, branch, partner = supplier_lines(spark, sf_dir)
    raw = {"volume_box": box, "volume_unload_detail": unload,
           "volume_load_detail": load_detail, "volume_sign": sign, "volume_stock": stock,
           "volume_path": path, "volume_waybill": waybill,
           "volume_load": load, "volume_traffic": traffic, "volume_traffic_detail": traffic_detail}
    return {**{name: as_raw_text(df, CLEAN_SPECS[name]) for name, df in raw.items()},
            "volume_basic": basic, "volume_pallet_detail": pallet, "volume_scan": scan,
            "volume_same_day": same_day, "volume_line": trunk, "volume_branch_line": branch,
            "volume_partner_line": partner}


def as_raw_text(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """The feed as the operational systems export it: all configured fields, times as ISO text.

    By the record's number, some creation times are NULL spellings (``% 97 == 5``) or no dates
    (``% 97 == 6``), and every 10th record comes in three versions, of which the first has an older
    and the last no inflow time.  Fields that the driver tables have nothing for are
    NULL spellings.
    """
    df = df.selectExpr("*", f"cast(regexp_extract({spec.keys[0]}, '[0-9]+', 0) AS bigint) AS __pf_no") \
        .selectExpr("*", "explode(CASE WHEN __pf_no % 10 = 3 THEN array(0, 1, 2) ELSE array(1) END) AS __pf_version")
    own = {"inflow_time": "CASE __pf_version WHEN 0 THEN cast(inflow_time AS timestamp_ntz) - INTERVAL 1 DAY "
                          "WHEN 1 THEN cast(inflow_time AS timestamp_ntz) END"}

    def text(c: str) -> str:
        if c not in df.columns:
            return r"r'\N'"
        if c not in spec.ts_cols:
            return c
        iso = f"date_format({own.get(c, f'cast({c} AS timestamp_ntz)')}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
        if c != "create_time":
            return f"coalesce({iso}, 'NULL')"
        return f"CASE __pf_no % 97 WHEN 5 THEN 'null' WHEN 6 THEN '2001-13-45T00:00:00.000Z' ELSE {iso} END"

    return df.selectExpr(*[f"{text(c)} AS {c}" for c in spec.columns])
