"""Schemas of the records that pass between stages."""

from __future__ import annotations

SERIES = "title string, url string, slug string, catalog_page_url string, episode_count bigint, views_text string"
EPISODE = "title string, url string, list_page_url string, description string, duration string, published_text string"
SEGMENT = "timestamp string, text string"
DOCUMENT = (
    "doc_id string, source_site string, source_type string, podcast_title string, title string, url string, list_page_url string, retrieved_at string, language string, "
    "clean_text string, content_hash string, extraction_method string, duration string, published_date string, published_text string, description string, "
    "metadata struct<segment_count:bigint,text_char_count:bigint,podcast_slug:string,podcast_path:string>"
)
CLEANING = (
    "cleaning_version string, original_chars bigint, normalized_chars bigint, cleaned_chars bigint, removed_chars bigint, removed_blocks bigint, "
    "removed_inline_phrases bigint, removed_consecutive_duplicate_blocks bigint, remove_reasons map<string,bigint>"
)
CHUNK = (
    "chunk_id string, doc_id string, chunk_index bigint, provider string, source_type string, podcast_slug string, title string, url string, start_timestamp string, "
    "end_timestamp string, char_count bigint, block_count bigint, text string, source_file string, timestamp_aware boolean, chunk_content_hash string"
)
REWRITE = "original_query string, canonical_terms array<string>, core_query string, retrieval_queries array<string>, rewrite_used boolean, provider string, model string, fallback_reason string"
REWRITE_STRUCT = "struct<" + REWRITE.replace(" array", ":array").replace(" string", ":string").replace(" boolean", ":boolean").replace(", ", ",") + ">"
CACHE = f"cache_key string, result {REWRITE_STRUCT}"
