"""Row kinds: their columns (as DDL) and what each stage of a pipeline needs of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame

CHUNK = "hf_row_id string, document_id string, document_name string, chunk_index int, chunk_type string, text string"
_BASE = "id bigint, origin_id bigint, sample_id array<string>, sample_text array<struct<hf_row_id:string,text:string,document_name:string>>, status string"
_MORE = "input_id bigint, GEN_TYPE string, num_chunks int, doc_constraint string, similarity_job_index int, similarity_mode string, similarity_threshold double, similarity_min double, similarity_max double, min_matching_words int, chunk_group_similarity double"
QA = f"{_BASE}, question string, answer string, {_MORE}"
STYLED_QA = f"{_BASE}, question string, answer string, {_MORE}, question_style string, document_id string"
CONVERSATION = f"{_BASE}, messages array<struct<role:string,content:string>>, input_id bigint"
JUDGED = f"{_BASE}, messages array<struct<role:string,content:string>>, input_id bigint, scores map<string,double>, avg_score double"

#: What a stage must find in its input: a subset of columns, so rows may carry more.
REQUIRED = {
    "qa": ("id", "sample_id", "sample_text", "question", "answer"),
    "styled_qa": ("id", "sample_id", "sample_text", "question", "answer", "question_style"),
    "conversation": ("id", "sample_id", "sample_text", "messages"),
    "judged": ("id", "sample_id", "messages", "scores", "avg_score"),
}


def missing(df_or_columns, kind: str) -> list[str]:
    columns = df_or_columns.columns if isinstance(df_or_columns, DataFrame) else df_or_columns
    return [c for c in REQUIRED[kind] if c not in columns]
