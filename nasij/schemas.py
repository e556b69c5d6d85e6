"""Record types of the pipeline as DDL strings."""

from __future__ import annotations

INTERIM = "doc_id string, corpus string, title string, author string, source string, license string, region string, raw_text string, source_format string"
FACT = "struct<type: string, value: string, position_in_text: int>"
CHUNK = (
    "chunk_id string, doc_id string, source string, license string, region string, format_type string, token_count bigint, chunk_text string, "
    "source_pointer struct<unit_start: int, unit_end: int, unit_count: int, unit_type: string>, title string, author string, review_flags array<string>"
)
CHUNK_FACTS = f"source_chunk_id string, source_region string, extracted_facts array<{FACT}>"
OCR_WORD = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf string, text string"
SFT = "instruction string, response string, source_chunk_id string, source_region string, format_type string, model_version string"
DPO = "prompt string, chosen string, rejected string, source_chunk_id string, source_region string, rejection_type string, model_version string, format_type string"
MANIFEST = "doc_id string, title string, author string, source_site string, url string, license string, license_note string, domain string, format string, date_checked string, region string, corpus_phase string"
MESSAGE = "struct<role: string, content: string>"
SAMPLE = (
    f"sample_id string, chunk_id string, question string, thinking string, answer string, messages array<{MESSAGE}>, question_type string, difficulty string, reasoning_mode string, reasoning_depth int, "
    "language string, dialect string, validation_status string, teacher_only struct<support_facts: array<string>>, split string"
)
# The enumerations of a sample.
SPLITS = ("train", "validation", "test")
STATUSES = ("UNVERIFIED", "VERIFIED", "REJECTED")
