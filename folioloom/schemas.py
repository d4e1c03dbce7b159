"""Declared schemas of canonical tables and views; nothing is inferred from data."""

from __future__ import annotations

SCHEMA_VERSION = "1"
TASKS = ("layout", "text", "table", "formula", "diagram", "seal")
STAGES = ("sft", "rlvr", "eval")

#: One superset for the targets of all tasks, so that a plan reads only the nested columns it needs.
TARGET = "struct<coordinate_space:string,elements:array<struct<region_id:string,bbox:array<double>,label:string,rotation:int,reading_order:int>>,text:string,html:string,otsl:string,enhanced_otsl:string,latex:string,display:boolean,raw:string>"

DOCUMENTS = "document_id string, source_name string, source_document_id string, document_path string, document_type string, num_pages int, language string, domain string, checksum string, metadata string, schema_version string"
PAGES = "page_id string, document_id string, source_name string, source_page_id string, page_index int, page_image_asset_id string, width int, height int, rotation double, attributes string, schema_version string"
REGIONS = "region_id string, page_id string, document_id string, source_name string, source_annotation_id string, bbox array<double>, rotation double, element_type string, category string, subcategory string, reading_order int, crop_asset_id string, quality_flags array<string>, metadata string, schema_version string"
RECORDS = f"record_id string, task string, source_name string, document_id string, page_id string, region_id string, image_asset_id string, target {TARGET}, category string, subcategory string, language string, quality_flags array<string>, provenance string, metadata string, schema_version string"
ASSETS = "asset_id string, asset_type string, source_name string, document_id string, page_id string, region_id string, task string, path string, width int, height int, format string, checksum string, parent_asset_id string, transform_spec_hash string, coordinate_space string, transform string, schema_version string"

CANONICAL = {"documents": DOCUMENTS, "pages": PAGES, "regions": REGIONS, "records": RECORDS, "assets": ASSETS}
KEYS = {"documents": "document_id", "pages": "page_id", "regions": "region_id", "records": "record_id", "assets": "asset_id"}
