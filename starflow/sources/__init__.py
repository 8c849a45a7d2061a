"""Typed scans and extractors (inventory S1-S8, S10, K9)."""

from .files import read_csv, read_preamble_csv, scan
from .html import html_links, html_rows, html_table_pairs
from .labels import parse_label_lines, parse_label_text, read_label_files
from .spine import date_spine, date_spine_between

__all__ = [
    "read_csv", "read_preamble_csv", "scan",
    "html_links", "html_rows", "html_table_pairs",
    "parse_label_lines", "parse_label_text", "read_label_files",
    "date_spine", "date_spine_between",
]
