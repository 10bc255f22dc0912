"""Table layouts.

Fixed values: these column names and types are the public contract of the tables, so
that dashboards written against them keep working.
"""

BRONZE_COLUMNS = [
    "_source_id",
    "body_json",
    "_rescued_data",
    "_source_hash",
    "_source_file",
    "_ingestion_id",
    "_ingestion_timestamp",
    "_source_path",
    "_load_type",
    "_ingestion_date",
]

BRONZE_DDL = (
    "_source_id string, body_json string, _rescued_data string, _source_hash string, "
    "_source_file string, _ingestion_id string, _ingestion_timestamp timestamp, "
    "_source_path string, _load_type string, _ingestion_date date"
)

RUN_LOG_DDL = (
    "_ingestion_id string, collection string, load_type string, watermark_inicial string, "
    "watermark_final string, qtd_lida_origem bigint, qtd_gravada_destino bigint, "
    "start_time timestamp, end_time timestamp, duracao_seg double, status string, "
    "mensagem_erro string, qtd_quarentena bigint, qtd_duplicada_lote bigint, "
    "divergencia_pct double, contrato_ok boolean, landing_files array<string>, "
    "ingest_mode string, pipeline_version string"
)

WATERMARK_DDL = (
    "collection string, watermark_field string, watermark_value string, "
    "watermark_type string, _ingestion_id string, updated_at timestamp"
)

VIOLATIONS_DDL = (
    "_ingestion_id string, collection string, field string, kind string, detail string, "
    "violation_pct double, detected_at timestamp"
)

LOAD_KEYS_DDL = "_ingestion_id string, collection string, n_rows bigint, keys binary"

ACCUMULATED_DDL = (
    "_ingestion_id string, collection string, soma_control_log bigint, linhas_bronze bigint, estimated_keys bigint, "
    "delta bigint, recounted boolean, accumulated_ok boolean, checked_at timestamp"
)

SUMMARY_COLUMNS = [
    "collection",
    "load_type",
    "status",
    "qtd_lida_origem",
    "qtd_gravada_destino",
    "watermark_inicial",
    "watermark_final",
    "divergencia_pct",
    "qtd_quarentena",
    "duracao_seg",
    "mensagem_erro",
]

MANIFEST_DDL = (
    "run_id string, ingested_at string, source_catalog string, source_schema string, "
    "source_database string, source_table string, status string, row_count bigint, "
    "file_name string, file_path string, file_size_bytes bigint, duration_sec double, "
    "error string"
)

CONSOLIDATION_DDL = (
    "table_name string, status string, arquivos int, linhas_lidas bigint, "
    "linhas_bronze bigint, target_table string, error string"
)
