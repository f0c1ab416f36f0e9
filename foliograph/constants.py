"""Fixed values that decide results: patterns, word lists, limits.

Everything here has to keep its exact value; the rest of the package only
refers to these names.
"""

# --- fixed values: whitespace and line breaks -------------------------------
# Contents of a regex character class, valid for Java and RE2 alike.
SPACE_CLASS = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
INLINE_SPACE_CLASS = "\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
LINE_BREAK_CLASS = "\n-\r\x1c-\x1e\x85\u2028\u2029"
RARE_SPACE_CLASS = "\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: words ----------------------------------------------------
MONTHS = (
    r"Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|"
    r"Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
)
MONTH_PREFIXES = "janfebmaraprmayjunjulaugsepoctnovdec"
STOPWORDS = [
    "a", "an", "and", "the", "of", "in", "on", "for", "to", "by", "with", "as", "at", "from",
    "is", "are", "be", "was", "were", "this", "that", "these", "those", "it", "its",
]
LONE_MARKERS = r"bullet_point|bullet|•|◦|▪|‣|–|-|—"
DOCUMENT_SUFFIXES = [".pdf"]
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".tif", ".tiff", ".bmp", ".gif"]
PAGE_TITLE_KEYS = ["page_title", "title", "pageTitle", "heading", "section_title", "name"]
TITLE_KEYS = ["title", "page_title", "pageTitle", "heading", "section_title", "section", "name"]
SUBTITLE_KEYS = [
    "subtitle", "sub_title", "page_subtitle", "subheading",
    "sub_section_title", "sub_section", "subsection",
]
TEXT_KEY_PARTS = [
    "text", "content", "narrative", "paragraph", "title", "subtitle", "note",
    "description", "speaker", "period", "quote", "slogan",
]
LETTER_KEYS = ["recipient", "addressee", "sender", "company_details", "header", "closing", "signatories"]
LETTER_HINT_KEYS = [
    "header", "addressee", "company_details", "content",
    "closing", "signatories", "cc", "footer",
]
DIAGNOSTIC_KEYS = [
    "debug", "raw_model_text", "error", "err",
    "sent_image_path", "sent_image_mime", "sent_image_bytes",
    "image_px", "image_token_est",
]
# Key names that a page of unknown shape may use; the first one with a value counts.
BODY_KEYS = ["content", "body", "message", "letter_body"]
PARAGRAPH_KEYS = ["text", "paragraph"]
NAME_KEYS = ["title", "name"]
HEADER_LIST_KEYS = ["headers", "columns"]
ROW_LIST_KEYS = ["rows", "cells", "data"]
COLUMN_LIST_KEYS = ["items", "values"]
COLUMN_NAME_KEYS = ["header", "name"]
SERIES_KEYS = ["data_series", "dataSeries", "series", "data"]
SERIES_NAME_KEYS = ["name", "title", "label"]
POINT_KEYS = ["data", "values", "points"]
CHART_TYPE_KEYS = ["chart_type", "chartType", "chart", "type"]
TABLE_HINT_KEYS = {"rows", "headers", "cells", "columns", "data"}
CHART_HINT_KEYS = {"series", "data_series", "data", "xaxis", "yaxis", "chart"}
PRIORITY_HEADING = (
    r"\b(SIP|If you had invested|If you had invested ₹|If you had invested Rs|"
    r"Systematic Investment Plan)\b"
)
DATE_STRENGTH = {
    "footer": 5, "title/subtitle": 4, "page": 4, "folder": 3, "pdf_meta_title": 2, "filename": 1,
}

# --- fixed values: date patterns -------------------------------------------
DATE_SEP = r"\s*[-_/., ]*\s*"
MONTH_YEAR = rf"(?i)\b({MONTHS})\s+(20\d{{2}})\b"
DAY_MONTH = rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?{DATE_SEP}({MONTHS})\b"
FULL_DATE = (
    rf"(?i)\b(?:\d{{1,2}}\s*(?:{MONTHS})\s*,?\s*\d{{4}}"
    rf"|(?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}}"
    r"|\d{4}-\d{2}-\d{2}"
    r"|\d{1,2}[/-]\d{1,2}[/-]\d{2,4})\b"
)
NAMED_DATE = (
    rf"(?i)\b(?:\d{{1,2}}(?:st|nd|rd|th)?\s+(?:{MONTHS})\s*,?\s*(?:19|20)\d{{2}}"
    rf"|(?:{MONTHS})\s+\d{{1,2}}(?:st|nd|rd|th)?\s*,?\s*(?:19|20)\d{{2}}"
    r"|\d{1,2}[/-]\d{1,2}[/-](?:19|20)\d{2})\b"
)
MONTH_WORD = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
STEM_DATES = [
    r"\b(20\d{2})[-_.](\d{1,2})[-_.](\d{1,2})\b",
    r"\b(\d{1,2})[-_.](\d{1,2})[-_.](20\d{2})\b",
    r"\b(20\d{2})(\d{2})(\d{2})\b",
    r"\b(\d{2})(\d{2})(20\d{2})\b",
    rf"(?i)\b((?:{MONTH_WORD})[a-z]*)[\s._-]*(\d{{1,2}})[\s._-]*(20\d{{2}})\b",
    rf"(?i)\b(\d{{1,2}})[\s._-]*((?:{MONTH_WORD})[a-z]*)[\s._-]*(20\d{{2}})\b",
]
# Tried on the whole stem by the relaxed reader; the flag says a year is present.
RELAXED_STEM_DATES = [
    r"\b(20\d{2})[_.-](\d{1,2})[_.-](\d{1,2})(?:[T _-]\d{2}[_:]\d{2}(?:[_:]\d{2})?(?:\.\d+)?Z?)?\b",
    r"\b(\d{1,2})[_.-](\d{1,2})[_.-](20\d{2})\b",
    r"\b(20\d{2})(\d{2})(\d{2})\b",
    r"\b(\d{2})(\d{2})(20\d{2})\b",
    rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?{DATE_SEP}({MONTHS}){DATE_SEP}(\d{{4}})\b",
    rf"(?i)\b({MONTHS}){DATE_SEP}(\d{{1,2}})(?:st|nd|rd|th)?{DATE_SEP}(\d{{4}})\b",
    *STEM_DATES,
]
ISO_TAIL = r"(\d{4})_(\d{2})_(\d{2})T\d{2}_\d{2}_\d{2}\.\d{3}Z$"
FOLDER_DATES = [r"\b(20\d{2})(\d{2})(\d{2})\b", r"\b(20\d{2})[-_](\d{1,2})[-_](\d{1,2})\b"]

# --- fixed values: limits ---------------------------------------------------
CAPTION_MAX_WORDS = 12
CHUNK_CHAR_LIMIT = 6000
CHUNK_BREAK_FROM = 3600
OVERFLOW_MIN_WORDS = 120
UNIT_MIN_WORDS = 28
UNIT_MAX_WORDS = 180
WINDOW_WORDS = 400
APPEND_BELOW_WORDS = 8
MIN_CHUNK_WORDS = 10
LINE_GAP = 6.0
HEADER_GAP = 4.0
TEXT_FIELD_LIMIT = 5000
REPAIR_MIN_GAIN = 0.05
MIN_YEAR, MAX_YEAR = 1990, 2100
IMAGE_TOKEN_DIVISOR = 750
IMAGE_MAX_BYTES = 4_500_000
IMAGE_BUDGET_BYTES = 3_919_872
MAX_ATTEMPTS = 3
RETRY_BASE_SECONDS = 2.0
