"""Schemas of exchanged bundles and stored tables."""

from __future__ import annotations

EVIDENCE = "array<struct<page_number:int,source_kind:string,quote_text:string,section_title:string>>"
PATHS = "struct<invoice:string,credit_note:string,remark:string>"
CONSTRAINTS = "struct<min_char_length:int,max_char_length:int,min_decimal_scale:int,max_decimal_scale:int,format_hint:string>"
FIELD = (
    "field_code:string,field_name:string,field_kind:string,parent_group_code:string,field_description:string,data_type:string,occurrence_min:int,occurrence_max:string,"
    f"sample_value:string,value_set_refs:array<string>,semantic_notes:string,paths:{PATHS},constraints:{CONSTRAINTS},origin:string,confidence:double,evidence:{EVIDENCE}"
)
RULE = f"rule_code:string,rule_type:string,expression_text:string,referenced_fields:array<string>,severity:string,origin:string,confidence:double,evidence:{EVIDENCE}"
CODE_LIST = f"code_list_name:string,entries:array<struct<code:string,label:string,description:string>>,origin:string,confidence:double,evidence:{EVIDENCE}"
DOCUMENT = "jurisdiction:string,tax_domain:string,language_code:string,version_label:string,issued_on:date,effective_from:date,effective_to:date,source_path:string"
BUNDLE = f"document struct<{DOCUMENT}>, fields array<struct<{FIELD}>>, rules array<struct<{RULE}>>, code_lists array<struct<{CODE_LIST}>>"

VERSION = "document_version_id bigint, checksum_sha256 string, source_uri string, version_label string, jurisdiction string, tax_domain string, language_code string, status string, issued_on date, effective_from date, effective_to date, created_at timestamp, published_at timestamp"
RUN = "run_id string, document_version_id bigint, stage string, started_at timestamp, metrics string"
DECISION = "document_version_id bigint, diff_id string, decision string, reviewer string, comment string, decided_at timestamp"
ARTIFACT = "document_version_id bigint, bundle_type string, bundle_status string, artifact_uri string, checksum_sha256 string, created_at timestamp"
QUEUE_ITEM = "document_version_id bigint, diff_id string, item_id string, risk_level string, source string, status string, created_at timestamp"
DIFF = "document_version_id bigint, diff_id string, base_version_id bigint, candidate_version_id bigint, status string, summary string, created_at timestamp"
FIELD_ROW = (
    "document_version_id bigint, field_code string, field_name string, field_kind string, parent_group_code string, description string, data_type string, occurrence_min int, occurrence_max string, sample string, value_set_refs array<string>,"
    "notes string, report_level string, min_char_length int, max_char_length int, min_decimal_scale int, max_decimal_scale int, format_hint string, origin string, confidence decimal(4,3), ord bigint"
)
PATH_ROW = "document_version_id bigint, field_code string, doc_kind string, path_text string, remark string"
#: id: the place in the list of evidence. A citation belongs to a field, a rule or a code list.
CITATION = "document_version_id bigint, field_code string, id bigint, page_number int, section_title string, source_kind string, quote_text string"
RULE_ROW = "document_version_id bigint, rule_code string, rule_type string, expression_text string, normalized_expression string, severity string, origin string, confidence decimal(4,3)"
RULE_LINK = "document_version_id bigint, rule_code string, ref string"
RULE_CITATION = CITATION.replace("field_code", "rule_code")
CODE_LIST_ROW = "document_version_id bigint, code_list_name string, origin string, confidence decimal(4,3)"
CODE_ENTRY = "document_version_id bigint, code_list_name string, position int, code string, label string, description string"
CODE_LIST_CITATION = CITATION.replace("field_code", "code_list_name")
CHANGE = "document_version_id bigint, field_code string, change_type string, risk_level string, auto_approved boolean"
BASELINE = "jurisdiction string, tax_domain string, profile string, document_version_id bigint, promoted_at timestamp"
ISSUE = "document_version_id bigint, severity string, code string, field_code string, subject string"
