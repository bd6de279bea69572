"""Control tables derived from the sample tables, for queries and tests.

The texts are plain SQL that more than one engine can run; ``render`` puts in the few spellings that
differ. Every table grows with the sample data: work items with ``part``, the run log with
``lineitem``, errors with ``events``, edges with ``supplier``, batch history with ``orders``.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loadkeeper.plans.worklists import Control

SPARK = {"ts": "TIMESTAMP_NTZ", "explode": "explode", "list": "array({})", "text": "string"}
DUCK = {"ts": "TIMESTAMP", "explode": "unnest", "list": "[{}]", "text": "varchar"}

# [each 1..7] makes one row per number; [ts x] is a timestamp; {table} names an input.
TEXTS = {
    "sources": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS source_id, r_name AS source_name, r_regionkey <> 4 AS enabled
        FROM {region}""",
    "jobs": "SELECT [each 1..7] AS job_id, true AS enabled",
    "objects": """
        SELECT p_partkey AS object_id, p_partkey % 5 + 1 AS source_id,
          CASE WHEN p_partkey % 3 = 0 THEN 'OBJ_' ELSE 'obj_' END || p_partkey AS table_name
        FROM {part}""",
    "items": """
        SELECT p * 7 + j - 1 AS job_object_id, j AS job_id, p % 5 + 1 AS source_id, p AS object_id,
          CASE WHEN j = 1 AND p % 11 = 0 THEN 'slt_ods.vbrp_' || p
               WHEN j = 1 AND p % 13 = 0 THEN 'apps.XLA_distribution_links'
               WHEN j = 1 AND p % 19 = 0 THEN 'ExportedMetadata_' || p
               ELSE 'obj_' || p || '_' || j END AS source_object_name,
          'FCCS_files/Export_' || p || '.ZIP' AS source_object_path,
          CASE WHEN p % 3 = 0 THEN 'select a.* from obj_' || p || ' a' END AS source_query,
          CASE p % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'vkorg in (@vkorg)'
            WHEN 3 THEN 'bukrs in (@BUKRS) and werks in (@werks)' WHEN 4 THEN 'bwkey in (@bwkey)'
            WHEN 5 THEN 'segment1 in (@segment1) or segment2 in (@segment2)' ELSE 'flag = ''x''' END AS source_filter,
          CASE WHEN p % 4 = 1 THEN 'creation_date' END AS source_filter_add,
          CASE WHEN p % 9 = 8 THEN NULL WHEN p % 5 = 1 THEN 'slt_update' ELSE 'last_update_date' END
            AS source_update_identifier,
          CASE WHEN p % 5 = 1 THEN CASE CAST(floor(p / 5) AS BIGINT) % 7 WHEN 0 THEN 'ryear' WHEN 1 THEN 'GJAHR'
              WHEN 2 THEN 'budat' WHEN 3 THEN 'AEDAT' WHEN 4 THEN 'slt_update' WHEN 5 THEN 'cpudt' ELSE 'other' END
            WHEN p % 17 = 3 THEN 'fkdat' ELSE 'creation_date' END AS source_update_identifier_hist,
          'Raw/Obj_' || p AS target_object_path,
          CASE WHEN j = 1 THEN 'raw.obj_' || p || '_1' WHEN j = 2 THEN 'dq.obj_' || p || '_2'
               WHEN j = 3 THEN 'rfn.obj_' || p || '_3'
               WHEN j = 4 THEN 'dwh.' || CASE WHEN p % 2 = 0 THEN 'dim' ELSE 'fact' END || '_' || p || '_4'
               WHEN j = 5 AND p IN (2, 7, 12) THEN 'dwh.rpt_general_ledger_fccs'
               WHEN j = 5 THEN CASE p WHEN 5 THEN 'dwh.rpt_general_ledger_oracle'
                 WHEN 6 THEN 'dwh.rpt_general_ledger_sap' WHEN 10 THEN 'dwh.rpt_general_ledger_oracle_sl'
                 ELSE 'dwh.rpt_' || p || '_5' END
               WHEN j = 6 THEN 'dwh.sum_' || p || '_6'
               ELSE CASE WHEN p % 3 = 0 THEN 'DWH.recon_gl_' ELSE 'dwh.recon_xx_' END || p || '_7' END
            AS target_object_name,
          CASE WHEN p_size % 10 <> 0 THEN 1 ELSE 0 END AS enabled,
          CASE CAST(floor(p / 5) AS BIGINT) % 4 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE 0 END AS is_full_load,
          CASE CAST(floor(p / 10) AS BIGINT) % 5 WHEN 1 THEN 1 WHEN 4 THEN NULL ELSE 0 END AS is_full_load_hist,
          CASE WHEN p % 23 = 0 THEN NULL
               ELSE [ts 2023-02-05 06:30:15.250] + CAST(p % 400 AS INT) * INTERVAL '1' DAY END AS last_run_time,
          CASE WHEN j < 4 OR p % 4 = 0 THEN NULL WHEN p % 4 = 1 THEN ''
               WHEN j = 4 THEN CASE WHEN p % 3 = 1 THEN upper(near) ELSE near END
               WHEN p % 4 = 2 THEN CASE WHEN p % 3 = 1 THEN upper(near) ELSE near END
               WHEN p % 16 = 15 THEN near || ',' || near
               ELSE near || ',' || far END AS dependent_table_list,
          p_size % 2 + 1 AS execution_sequence
        FROM (
          SELECT p, j, p_size,
            CASE j WHEN 4 THEN 'obj_' || (p - 5) || '_3'
              WHEN 5 THEN 'dwh.' || CASE WHEN p % 2 = 1 THEN 'dim' ELSE 'fact' END || '_' || (p - 5) || '_4'
              WHEN 6 THEN 'dwh.rpt_' || (p - 5) || '_5' ELSE 'dwh.sum_' || (p - 5) || '_6' END AS near,
            CASE j WHEN 5 THEN 'dwh.' || CASE WHEN p % 2 = 0 THEN 'dim' ELSE 'fact' END || '_' || (p - 10) || '_4'
              WHEN 6 THEN 'dwh.rpt_' || (p - 10) || '_5' ELSE 'dwh.sum_' || (p - 10) || '_6' END AS far
          FROM (SELECT p_partkey AS p, p_size, [each 1..7] AS j FROM {part}) expanded
        ) named""",
    "batches": """
        SELECT b AS batch_id, (b - 1) % 5 + 1 AS source_id,
          [ts 2024-01-01 04:00:00] + CAST(floor((b - 1) / 5) AS INT) * INTERVAL '1' DAY AS batch_start_date
        FROM (SELECT DISTINCT o_orderkey % 10 + 1 AS b FROM {orders}) runs""",
    "history": """
        SELECT o_orderkey AS batch_id, o_orderkey % 5 + 1 AS source_id, o_orderdate AS batch_start_date,
          o_orderdate AS trigger_time, CASE WHEN o_orderkey % 3 = 0 THEN 'main' ELSE 'side_' || o_orderpriority END
            AS pipeline_name,
          CASE o_orderstatus WHEN 'F' THEN 'Successfully Completed' WHEN 'O' THEN 'Active'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Partially Failed' ELSE 'FAILED ' END END AS batch_run_status
        FROM {orders}""",
    "log": """
        SELECT l_orderkey % 10 + 1 AS batch_id, l_partkey % 5 + 1 AS source_id, CAST(l_linenumber AS BIGINT) AS job_id,
          l_partkey * 7 + l_linenumber - 1 AS job_object_id,
          CAST(floor(l_quantity) AS INT) AS source_row_count,
          CAST(floor(l_quantity) AS INT) - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target_row_count,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS rejeted_row_count,
          CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_suppkey % 3 AS INT) END AS rejected_duplicate_count,
          CAST(floor(l_extendedprice) AS BIGINT) * 100000 AS target_size,
          CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_linenumber = 5 THEN 'Success ' ELSE 'success' END
               WHEN l_quantity > 45 THEN NULL ELSE 'failed' END AS status,
          [ts 2024-01-01 06:00:00] + CAST(floor((l_orderkey % 10) / 5) AS INT) * INTERVAL '1' DAY AS log_date,
          l_shipdate AS object_start_date,
          l_shipdate + CAST(l_linenumber AS INT) * INTERVAL '1' MINUTE
            + CAST(l_suppkey % 60 AS INT) * INTERVAL '1' SECOND AS object_end_date
        FROM {lineitem}""",
    "stage_log": """
        SELECT l_orderkey % 10 + 1 AS batch_id, l_partkey * 7 + stage - 1 AS job_object_id,
          CAST(floor(l_quantity) AS INT) AS source_row_count,
          CAST(floor(l_quantity) AS INT) - CASE WHEN stage >= 2 AND l_returnflag = 'R' THEN 1 ELSE 0 END
            - CASE WHEN stage = 3 AND l_returnflag = 'A' AND l_linenumber = 7 THEN 1 ELSE 0 END AS target_row_count,
          CASE WHEN stage >= 2 AND l_returnflag = 'R' THEN 1 END AS rejected_duplicate_count
        FROM (SELECT *, [each 1..3] AS stage FROM {lineitem}) staged
        WHERE NOT (stage = 2 AND l_partkey % 50 = 0)""",
    "errors": """
        SELECT event_id AS error_log_id, event_id % 10 + 1 AS batch_id, user_id % 5 + 1 AS source_id,
          event_id % 7 + 1 AS job_id, user_id * 7 + event_id % 7 AS job_object_id, ts AS log_date,
          CASE event_id % 4 WHEN 0 THEN 'UserError' WHEN 1 THEN 'TECHNICALERROR' WHEN 2 THEN 'DQCheckError '
            ELSE CASE WHEN event_id % 3 = 0 THEN 'OtherError' END END AS error_type,
          CASE event_id % 5 WHEN 0 THEN 'NullCheckError' WHEN 1 THEN 'RangeError' WHEN 2 THEN 'logicalerror'
            WHEN 3 THEN 'Unlisted' END AS error_subtype
        FROM {events} WHERE event_type = 'error'""",
    "edges": """
        SELECT s * 4 + j - 4 AS dependency_id, s % 5 + 1 AS source_id, j AS job_id, s * 7 + j - 1 AS job_object_id,
          CASE WHEN j = 4 THEN s % 2 + 1 WHEN j = 5 THEN CAST(floor(s / 2) AS BIGINT) % 2 + 1 ELSE 1 END
            AS ExecutionSequence,
          (s + 1) % 5 + 1 AS dependent_source_id,
          CASE WHEN s % 3 = 0 THEN j ELSE j - 1 END AS dependent_job_id,
          (s + 1) * 7 + CASE WHEN s % 3 = 0 THEN j - 1 ELSE j - 2 END AS dependent_job_object_id,
          s % 7 <> 0 AS enabled
        FROM (SELECT s_suppkey AS s, [each 4..7] AS j FROM {supplier}) expanded""",
    "edges_null": """
        SELECT dependency_id, source_id, job_id,
          CASE WHEN dependency_id % 40 = 12 THEN NULL ELSE job_object_id END AS job_object_id, ExecutionSequence,
          dependent_source_id, dependent_job_id, dependent_job_object_id, enabled
        FROM edges""",
    "datasets": """
        SELECT p_partkey AS id, 'domain_' || p_partkey % 25 AS domain_name, p_brand AS datasetid,
          'tab_' || p_partkey % 40 AS table_name,
          CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '2023-' || (p_partkey % 12 + 1)
            WHEN 3 THEN '2024-' || (p_partkey % 12 + 1) ELSE '2024-0' || (p_partkey % 9 + 1) END AS partition_name,
          p_size % 10 <> 0 AS enabled, CASE p_partkey % 6 WHEN 0 THEN 'W' WHEN 1 THEN NULL ELSE 'D' END AS job_frequency,
          CASE WHEN p_brand LIKE '%1' THEN 'NA' WHEN p_brand LIKE '%2' THEN NULL ELSE '4' END AS maxparallelism,
          CASE WHEN p_partkey % 4 = 0 THEN 'Y' ELSE 'N' END AS recalc_consider,
          CAST(p_size % 3 + 1 AS [text]) AS execution_sequence,
          CASE WHEN p_partkey % 97 = 5 THEN NULL ELSE p_partkey * 7 END AS domain_id,
          CAST(p_size % 4 AS [text]) AS quarter_name, 'g' || p_partkey % 3 AS groupid
        FROM {part}""",
    "packed_codes": """
        SELECT n_nationkey + 1000 AS vkorg, n_nationkey AS werks,
          CASE WHEN n_regionkey = 0 THEN NULL ELSE n_nationkey * 10 END AS bukrs, n_nationkey * 1000 AS bwkey
        FROM {nation}""",
    "segment_codes": "SELECT n_nationkey + 200 AS segment1, n_regionkey AS segment2 FROM {nation}",
    "history_keys": "SELECT CAST(n_nationkey + 90000000 AS [text]) AS vbeln FROM {nation}",
    "thresholds": """
        SELECT 'Obj_' || s_suppkey * 3 AS table_name, CAST(floor(s_acctbal) AS INT) AS threshold FROM {supplier}""",
    "mapping": """
        SELECT p_partkey * 3 + k AS col_mapping_key, p_partkey * 7 + k AS job_object_id, p_partkey AS object_id
        FROM (SELECT p_partkey, [each 0..2] AS k FROM {part}) expanded""",
    "routing": """
        SELECT 'step_' || job_id AS topic, status, 'team' || job_id || '@example.com' AS tolist
        FROM (SELECT job_id, CASE s WHEN 1 THEN 'Success' ELSE 'failed' END AS status
              FROM (SELECT job_id, [each 1..2] AS s FROM (SELECT [each 1..7] AS job_id) steps) states) named""",
}
NEEDS = {"edges_null": ["edges"]}
INPUTS = ("region", "nation", "part", "supplier", "orders", "lineitem", "events", "customer", "documents")


def render(text: str, words: dict[str, str]) -> str:
    """The text in one engine's spelling."""

    def numbers(m):
        listed = ", ".join(f"CAST({i} AS BIGINT)" for i in range(int(m[1]), int(m[2]) + 1))
        return f"{words['explode']}({words['list'].format(listed)})"

    text = re.sub(r"\[each (\d+)\.\.(\d+)\]", numbers, text)
    text = re.sub(r"\[ts ([^\]]+)\]", rf"CAST('\1' AS {words['ts']})", text)
    return text.replace("[text]", words["text"])


@lru_cache(maxsize=None)
def _schema(folder: str, name: str) -> StructType:
    return SparkSession.active().read.parquet(f"{folder}/{name}.parquet").schema


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table; its schema is read from the file footers once per process."""
    return spark.read.schema(_schema(folder, name)).parquet(f"{folder}/{name}.parquet")


class Tables:
    """The sample tables and the control tables derived from them, planned on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self._derive(name) if name in TEXTS else read(self.spark, self.folder, name)
        setattr(self, name, table)
        return table

    def _derive(self, name: str) -> DataFrame:
        text = render(TEXTS[name], SPARK)
        for need in NEEDS.get(name, ()):
            text = text.replace(f"FROM {need}", f"FROM {{{need}}}")
        inputs = {t: getattr(self, t) for t in (*INPUTS, *NEEDS.get(name, ())) if "{" + t + "}" in text}
        return self.spark.sql(text, **inputs)

    def control(self, edges: str = "edges") -> Control:
        return Control(
            items=self.items, sources=self.sources, jobs=self.jobs, objects=self.objects,
            log=self.log, batches=self.batches, edges=getattr(self, edges),
        )


def duck_ctes(*names: str) -> str:
    """``WITH`` clause that defines the named control tables for the comparison engine."""
    order = [n for n in TEXTS if n in names or any(n in NEEDS.get(m, ()) for m in names)]
    parts = [f"{n} AS ({render(TEXTS[n], DUCK).format(**{t: t for t in INPUTS})})" for n in order]
    return "WITH " + ",\n".join(parts)
