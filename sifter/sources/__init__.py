"""Readers: document and slide folders, lines, passages, page dictionaries."""

from .files import (number_lines, read_lines, read_page_dict, read_page_dict_positional, read_passages,
                    scan_documents, scan_slides)
from .slides import drop_unreadable, extract_slides
