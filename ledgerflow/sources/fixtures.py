"""ERP-shaped inputs derived from the driver's generic test tables.

The jobs this library serves read per-region companies, operations and
economic-concept tables, a concept-to-account mapping sheet and a CDC feed.
No such tables ship with the test data, so each is derived, in SQL that Spark
and DuckDB both accept, from the driver's ``customer``, ``orders``, ``events``
and ``lineitem`` tables.  The same text runs in Spark (``Fixtures``) and as a
CTE chain in front of every DuckDB oracle query (``ledgerflow.plans.oracle``),
so both sides see identical inputs.  Every view reads whole tables; nothing is sampled.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerflow import config as C

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# name -> SQL over {table} placeholders (base tables or earlier views).
VIEWS: dict[str, str] = {
    "fx_companies": """
SELECT CASE c_nationkey % 3 WHEN 0 THEN 'MX' WHEN 1 THEN 'BR' ELSE 'CO' END AS country,
       c_custkey AS customer_id,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS contract_id,
       c_name AS legal_name,
       concat('T', CAST(c_custkey AS string)) AS tax_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '1' ELSE '0' END AS status,
       MIN_ORDER.start_operation
FROM {customer}
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS start_operation
           FROM {orders} GROUP BY o_custkey) MIN_ORDER
       ON MIN_ORDER.o_custkey = c_custkey""",
    "fx_operations": """
SELECT c.country, o_orderdate AS insert_date, CAST(o_orderkey AS string) AS src_id,
       o_orderdate AS biz_date, o_orderdate AS acct_date, o_orderpriority AS code,
       concat('op ', o_orderpriority) AS descr, o_custkey AS contract_id,
       CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS amount
FROM {orders} JOIN {fx_companies} c ON c.customer_id = o_custkey""",
    "fx_concepts": """
SELECT CASE user_id % 3 WHEN 0 THEN 'MX' WHEN 1 THEN 'BR' ELSE 'CO' END AS country,
       ts AS insert_date, CAST(event_id AS string) AS src_id,
       ts AS biz_date, ts AS acct_date, event_type AS code,
       concat('ec ', event_type) AS descr, user_id AS contract_id,
       CASE WHEN event_id % 4 = 0 THEN -value ELSE value END AS amount
FROM {events}""",
    # Mapping sheet: fixed rows (a small dimension, like the real sheet).
    "fx_concept_map": """
SELECT * FROM (VALUES
 ('1-URGENT','Normal',    'OP','urgent',     'D100','C100','2023','12','31'),
 ('1-URGENT','Correctora','OP','urgent rev', 'D101','C101','2023','12','31'),
 ('1-URGENT','Normal',    'OP','urgent old', 'DOLD','COLD','2023','1','15'),
 ('2-HIGH',  'Normal',    'OP','high',       'D200','NA',  '2023','12','31'),
 ('2-HIGH',  'Correctora','OP','high rev',   'NAD', 'C201','2023','12','31'),
 ('3-MEDIUM','Normal',    'OP','medium',     'D300','C300','2023','12','31'),
 ('click',   'Normal',    'EC','click',      'D400','C400','2023','12','31'),
 ('click',   'Correctora','EC','click rev',  'D401','C401','2023','12','31'),
 ('view',    'Normal',    'EC','view',       'D500','NAC', '2023','12','31'),
 ('view',    'Correctora','EC','view jan',   'D501','C501','2023','1','15'),
 ('view',    'Correctora','EC','view nov',   'D502','C502','2023','11','5'),
 ('purchase','Correctora','EC','purch rev',  'D600',CAST(NULL AS string),'2023','12','31'),
 ('error',   'Normal',    'OP','wrong type', 'D700','C700','2023','12','31')
) AS t(code, posting_class, register_type, map_descr, debit_account, credit_account, y, m, d)""",
    # A long history of sheet loads, one per order: (priority, class) keys with
    # many load dates each, unpadded date parts, real calendar collisions under
    # the concatenated key.  Exercises snapshot selection at table scale.
    "fx_sheet_history": """
SELECT o_orderpriority AS code,
       CASE WHEN o_orderstatus = 'F' THEN 'Correctora' ELSE 'Normal' END AS posting_class,
       'OP' AS register_type, concat('load ', o_orderstatus) AS map_descr,
       concat('D', CAST(o_custkey % 10 AS string)) AS debit_account,
       concat('C', CAST(o_custkey % 10 AS string)) AS credit_account,
       CAST(year(o_orderdate) AS string) AS y, CAST(month(o_orderdate) AS string) AS m,
       CAST(dayofmonth(o_orderdate) AS string) AS d
FROM {orders}""",
    "fx_concept_map_v1": """
SELECT * FROM {fx_concept_map} WHERE code NOT IN ('click', '3-MEDIUM')""",
    "fx_cdc": """
SELECT l_orderkey, l_linenumber, l_shipdate AS seq, l_shipdate AS change_ts,
       CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN 'U' ELSE 'D' END AS op,
       l_quantity, l_extendedprice
FROM {lineitem}""",
    # Three states of every key, newest sequence not last in file order.
    "fx_cdc_versions": """
SELECT 1 AS batch, l_orderkey, l_linenumber, seq + INTERVAL 5 DAY AS seq, change_ts,
       CASE WHEN op = 'D' THEN 'U' WHEN l_linenumber = 2 THEN 'D' ELSE op END AS op,
       l_quantity + 100 AS l_quantity, l_extendedprice
FROM {fx_cdc}
UNION ALL
SELECT 2 AS batch, l_orderkey, l_linenumber, seq, change_ts, op, l_quantity, l_extendedprice FROM {fx_cdc}
UNION ALL
SELECT 3 AS batch, l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 3 THEN seq + INTERVAL 5 DAY ELSE seq + INTERVAL 2 DAY END AS seq, change_ts,
       CASE WHEN l_linenumber = 1 THEN 'D' ELSE 'U' END AS op, l_quantity + 200 AS l_quantity, l_extendedprice
FROM {fx_cdc}""",
    # A client snapshot and an increment: shared keys with other values, keys
    # of their own on both sides, null keys on both sides.
    "fx_upsert_target": """
SELECT contract_id, legal_name, tax_id, 'target' AS origin
FROM {fx_companies} WHERE status = '0' OR country = 'MX'""",
    "fx_upsert_source": """
SELECT contract_id, legal_name, concat(tax_id, '-new') AS tax_id, 'source' AS origin
FROM {fx_companies} WHERE status = '1' OR country = 'BR'""",
    # Timestamps as text, some of it no timestamp.
    "fx_text_operations": """
SELECT src_id, code, amount,
       CASE WHEN code = '5-LOW' THEN concat('bad ', src_id)
            ELSE concat(CAST(insert_date AS string), '.000') END AS inserted
FROM {fx_operations}""",
    "fx_clients_prev": """
SELECT concat(country, '-', CAST(contract_id AS string)) AS client_id,
       CASE WHEN contract_id % 10 = 1 THEN concat(legal_name, ' old')
            WHEN contract_id % 10 = 2 THEN NULL ELSE legal_name END AS legal_name,
       CASE WHEN contract_id % 10 IN (2, 3) AND contract_id % 20 < 10 THEN concat(tax_id, 'x')
            ELSE tax_id END AS tax_id
FROM {fx_companies} WHERE status = '0' AND contract_id IS NOT NULL""",
}

_REF = re.compile(r"\{(\w+)\}")


# Layouts of the derived tables, in the library's spec vocabulary.
FX_OPERATIONS = C.TransactionSpec(
    type_value=C.TYPE_OPERATION, uuid_prefix="op-",
    columns={C.INSERT_DATE: "insert_date", C.UUID: "src_id", C.DATE: "biz_date",
             C.ACCOUNTING_DATE: "acct_date", C.INVOICE: "code",
             C.INVOICE_DESCRIPTION: "descr"},
    contract="contract_id", amount="amount")
FX_CONCEPTS = C.TransactionSpec(
    type_value=C.TYPE_CONCEPT, uuid_prefix="ec-",
    columns=dict(FX_OPERATIONS.columns), contract="contract_id", amount="amount")
FX_MAP = C.ConceptMapSpec(code="code", posting_class="posting_class",
                          register_type="register_type", description="map_descr",
                          year="y", month="m", day="d")
FX_CLIENTS = C.ClientSpec(status="status", contract="contract_id",
                          created_at="start_operation", company_name="legal_name",
                          tax_id="tax_id")
FX_CDC = C.ChangeFeedSpec(keys=("l_orderkey", "l_linenumber"), sequence="seq",
                          op="op", timestamp="change_ts",
                          tie_break=("op", "l_quantity", "l_extendedprice"))


class Fixtures:
    """Spark frames of the derived views over one scale-factor directory.

    ``Fixtures.of`` shares one instance per session and directory, so repeated
    queries reuse the resolved (lazy) frames instead of re-listing files and
    re-analysing the view SQL; no data is cached.
    """

    _shared: dict[tuple[str, str], "Fixtures"] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        try:
            session = spark.sparkContext.applicationId
        except Exception:  # sessions without a local SparkContext
            session = str(id(spark))
        key = (session, sf_dir.rstrip("/"))
        fx = cls._shared.get(key)
        if fx is None or fx.spark is not spark:
            fx = cls._shared[key] = cls(spark, sf_dir)
        return fx

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def view(self, name: str) -> DataFrame:
        if name not in self._frames:
            refs = {r: (self.view(r) if r in VIEWS else self.table(r))
                    for r in set(_REF.findall(VIEWS[name]))}
            self._frames[name] = self.spark.sql(VIEWS[name], **refs)
        return self._frames[name]

    # Convenience accessors.
    @cached_property
    def companies(self) -> DataFrame:
        return self.view("fx_companies")

    @cached_property
    def operations(self) -> DataFrame:
        return self.view("fx_operations")

    @cached_property
    def concepts(self) -> DataFrame:
        return self.view("fx_concepts")

    @cached_property
    def concept_map(self) -> DataFrame:
        return self.view("fx_concept_map")

    @cached_property
    def concept_map_v1(self) -> DataFrame:
        return self.view("fx_concept_map_v1")

    @cached_property
    def sheet_history(self) -> DataFrame:
        return self.view("fx_sheet_history")

    @cached_property
    def cdc(self) -> DataFrame:
        return self.view("fx_cdc")

    @cached_property
    def clients_prev(self) -> DataFrame:
        return self.view("fx_clients_prev")
