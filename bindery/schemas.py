"""Explicit schemas: staged records, store tables, run log."""

from __future__ import annotations

CHAPTER = "struct<number:double,url:string,cdn_domain_id:smallint,cdn_path_prefix:string,image_filenames:array<string>,image_ext_ids:array<smallint>,total_images:int>"
RECORD = (
    "slug string, judul string, tipe string, thumb_domain_id smallint, thumb_path string, status_id smallint, author string, artist string, alternative_title string, "
    "sinopsis string, rating double, genre_list array<string>, genre_ids array<smallint>, "
    f"chapters array<{CHAPTER}>, latest_chapter_number double, similar array<struct<slug:string,judul:string>>"
)
DEAD_LETTER = "slug string, reason string, detail string"
STAGED = f"{RECORD}, _status string, _error string"
TABLES = {
    "series": "id long, slug string, judul string, thumb_domain_id smallint, thumb_path string, tipe string, status_id smallint, author string, artist string, alternative_title string, sinopsis string, rating double, latest_chapter_number double, chapter_count int, created_at timestamp, updated_at timestamp",
    "chapters": "id long, series_id long, chapter_number double, chapter_url string, cdn_domain_id smallint, cdn_path_prefix string, image_filenames array<string>, image_ext_ids array<smallint>, total_images int, created_at timestamp, updated_at timestamp",
    "series_genres": "series_id long, genre_id smallint, created_at timestamp",
    "run_log": "operation string, status string, total_processed long, total_new long, total_updated long, total_failed long, details string, created_at timestamp",
}
