"""Schemas of the control tables, one StructType per table.

Wall-clock columns are TIMESTAMP_NTZ: the tables store local readings without a zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "INT": IntegerType(), "BIGINT": LongType(), "BOOLEAN": BooleanType(), "STRING": StringType(),
    "TIMESTAMP_NTZ": TimestampNTZType(), "MEASURE": DecimalType(38, 7),
}


def _struct(columns: str) -> StructType:
    """Column texts 'name TYPE [NOT NULL], ...' as a schema; needs no running session."""
    out = StructType()
    for column in columns.split(","):
        name, kind, *rest = column.split()
        out = out.add(name, _TYPES[kind], nullable=not rest)
    return out


_WORK_ITEM = """
job_object_id INT NOT NULL, job_id INT NOT NULL, source_id INT NOT NULL, source_job_id INT, object_id INT,
source_container_name STRING, source_object_path STRING, source_object_name STRING, source_query STRING,
source_filter STRING, source_sheet_name STRING, source_object_functional_name STRING, source_format STRING,
source_object_delimiter STRING, source_partitioned_by STRING, source_update_identifier STRING,
source_update_identifier_hist STRING, source_delete_identifier STRING, target_container_name STRING,
target_object_path STRING, target_object_name STRING, target_table_type STRING, target_format STRING,
target_object_delimiter STRING, target_partitioned_by STRING, enabled INT, load_type STRING,
rejected_object_path STRING, common_log_object_path STRING, common_log_object_name STRING,
last_modified_date TIMESTAMP_NTZ, is_absolute_path INT, method_name STRING, dq_check_flag INT,
is_full_load INT, is_full_load_hist INT, last_run_time TIMESTAMP_NTZ, Source_column_mapping STRING,
dependent_table_list STRING, execution_sequence INT, source_filter_add STRING
"""

_DATASET = """
id INT NOT NULL, domain_name STRING, datasetid STRING NOT NULL, table_name STRING NOT NULL, partition_name STRING,
load_type STRING, last_modified_date TIMESTAMP_NTZ NOT NULL, enabled BOOLEAN, job_frequency STRING,
dependent_table_list STRING, maxparallelism STRING, recalc_consider STRING, execution_sequence STRING, domain_id INT,
quarter_name STRING, groupid STRING
"""

_MAPPING = """
col_mapping_key BIGINT NOT NULL, job_object_id INT NOT NULL, object_id INT NOT NULL, source_column_name STRING,
column_type STRING, target_column_name STRING, target_column_data_type STRING, is_nullable STRING,
transformation_rule STRING, actv_flg STRING NOT NULL, source_format STRING, target_format STRING, length INT,
source_column_flag INT, surrogate_key_flag INT, alphanumeric_key_flag INT, uniqueness_key_flag INT,
natural_key_flag INT, house_keeping_column_flag INT, derived_column_flag INT, foreign_key_flag INT,
column_included_in_SCD INT, length_key_flag INT, range_key_flag INT, range_expression STRING, type_check_flag INT,
column_id INT, null_check_nk_combination_flag INT
"""

_DDL = {
    "source": """source_id INT NOT NULL, source_name STRING, source_description STRING NOT NULL,
        last_modified_date TIMESTAMP_NTZ NOT NULL, enabled BOOLEAN""",
    "job": """job_id INT NOT NULL, job_name STRING NOT NULL, job_description STRING, last_modified_date TIMESTAMP_NTZ,
        enabled BOOLEAN""",
    "object": """object_id INT NOT NULL, source_id INT NOT NULL, table_name STRING NOT NULL, natural_key_list STRING,
        last_modified_date TIMESTAMP_NTZ""",
    "job_object_details": _WORK_ITEM,
    "source_job_mapping": """source_job_id INT NOT NULL, source_id INT NOT NULL, job_id INT NOT NULL, dependent_on INT,
        enabled BOOLEAN, last_modified_date TIMESTAMP_NTZ, current_status STRING""",
    "source_job_dependency": """dependency_id INT NOT NULL, source_id INT NOT NULL, job_id INT NOT NULL, object_id INT,
        job_object_id INT, ExecutionSequence INT, dependent_source_id INT, dependent_job_id INT,
        dependent_object_id INT, dependent_job_object_id INT, dependency STRING, comment STRING,
        last_modified_date TIMESTAMP_NTZ, enabled BOOLEAN""",
    "object_column_mapping": _MAPPING,
    "batch_run_details": """batch_id BIGINT NOT NULL, source_id INT NOT NULL, job_id INT, source_job_id INT,
        trigger_id STRING, batch_start_date TIMESTAMP_NTZ, batch_end_date TIMESTAMP_NTZ, pipeline_name STRING,
        batch_log_message STRING, batch_run_status STRING, trigger_time TIMESTAMP_NTZ""",
    "audit_log": """log_id INT NOT NULL, trigger_id STRING, batch_id BIGINT, source_id INT, job_id INT,
        job_object_id INT, source_row_count INT, target_row_count INT, rejeted_row_count INT,
        rejected_duplicate_count INT, target_size BIGINT, log_date TIMESTAMP_NTZ, rejected_file_path STRING,
        inputfile_row_count INT, insert_row_count INT, update_row_count INT, load_type STRING, status STRING,
        query STRING, object_start_date TIMESTAMP_NTZ, object_end_date TIMESTAMP_NTZ, last_run_date TIMESTAMP_NTZ,
        current_run_date TIMESTAMP_NTZ, rejected_commonlog_path STRING""",
    "error_log": """error_log_id INT NOT NULL, trigger_id STRING, batch_id BIGINT, source_iD INT, job_iD INT,
        job_object_id INT, activity STRING, error_code STRING, error_type STRING, error_subtype STRING,
        error_message STRING, log_date TIMESTAMP_NTZ, notebook_name STRING, method_name STRING""",
    "execution_log_details": """log_id INT NOT NULL, trigger_id STRING, batch_id BIGINT, job_id INT, job_object_id INT,
        step_name STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, row_count BIGINT""",
    "email_details": """topic STRING, tolist STRING, cclist STRING, subject STRING, body STRING, status STRING,
        modified_time TIMESTAMP_NTZ""",
    "metadata_details": """owner STRING, table_name STRING, column_name STRING, column_id INT, data_length INT,
        data_type STRING, nullable STRING""",
    "schema_changes_track": """login_name STRING, program_name STRING, host_name STRING, event_type STRING,
        server_name STRING, database_name STRING, command_text STRING, last_modified_date TIMESTAMP_NTZ""",
    "sapfilter_details": "VKORG INT, WERKS INT, BUKRS INT, BWKEY INT, last_modified_date TIMESTAMP_NTZ NOT NULL",
    "oraclefilter_details": "segment1 INT, segment2 INT, last_modified_date TIMESTAMP_NTZ NOT NULL",
    "vbrp_historical_records": "VBELN STRING",
    "sap_filters_threshold": "table_name STRING, threshold INT",
    "powerbi_dataset_details": _DATASET,
    "recon_fa_sap_records": "domain STRING, le_number STRING, "
    + ", ".join(
        f"{m}_{side}"
        for m in ("cum_acquisition_value", "accum_depreciation", "depreciation")
        for side in ("rpt MEASURE", "certified MEASURE", "refined MEASURE", "match STRING")
    ),
    "viewname_s4": """viewname STRING, enable INT, loadtype STRING, keycolumns STRING, checkpointkey STRING,
        filter STRING, target_table_name STRING, target_schema_name STRING""",
    "lkptable": """tableid INT, tableschema STRING, tablename STRING, enable INT, filename STRING, container STRING,
        filepath STRING""",
    "viewname_s4_errorlog": "viewname STRING, log_date TIMESTAMP_NTZ, errormessage STRING",
}

SCHEMAS: dict[str, StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}


def audit_of(table: StructType, skip: tuple[str, ...] = ("Source_column_mapping",)) -> StructType:
    """The audit table of a config table: its columns, then what was done, by whom and when."""
    kept = StructType([f for f in table.fields if f.name not in skip])
    return kept.add("Activity", StringType()).add("change_doneBy", StringType()).add("modify_date", TimestampNTZType())


SCHEMAS["job_object_details_audit"] = audit_of(SCHEMAS["job_object_details"])
# Older copies that differ by a few columns.
SCHEMAS["job_object_details_copy"] = _struct(_WORK_ITEM).add("is_partition", IntegerType()).add("partition_name", StringType())
SCHEMAS["powerbi_dataset_details_older"] = StructType(
    [f for f in SCHEMAS["powerbi_dataset_details"].fields if f.name not in ("quarter_name", "groupid")]
)
