"""Tables, patterns and limits that must be exactly these for right results."""

# --- fixed values: preferred source formats per output type, best first ---------------------
TEXT_GLOBS = ("txt/utf-8", "txt/windows-125*", "txt/iso-8859-*", "txt/big5", "txt/ibm*", "txt/*")
HTML_GLOBS = ("html/utf-8", "html/windows-125*", "html/iso-8859-*", "html/*")
RST_GLOBS = ("rst/*",)
ANY_GLOBS = RST_GLOBS + HTML_GLOBS + TEXT_GLOBS
COVER_GLOBS = ("rst/*", "html/*", "readme/*", "txt/*", "tex/*")

SOURCE_FAMILIES = {
    "any": ANY_GLOBS,
    "html_first": HTML_GLOBS + RST_GLOBS + TEXT_GLOBS,
    "text_first": TEXT_GLOBS + RST_GLOBS,
    "rst_only": RST_GLOBS,
    "text_only": TEXT_GLOBS,
    "cover": COVER_GLOBS,
}

# --- fixed values: output type, source family (None: needs no source), in build order -------
BUILD_ORDER = (
    ("picsdir.images", "rst_only"),
    ("picsdir.noimages", "rst_only"),
    ("rst.gen", "rst_only"),
    ("txt.utf-8", "text_first"),
    ("html.images", "html_first"),
    ("html.noimages", "html_first"),
    ("epub.noimages", "any"),
    ("kindle.noimages", "any"),
    ("pdf.noimages", "rst_only"),
    ("cover.small", "cover"),
    ("cover.medium", "cover"),
    ("epub.images", "any"),
    ("kindle.images", "any"),
    ("pdf.images", "rst_only"),
    ("epub3.images", "any"),
    ("kf8.images", "any"),
    ("qrcode", None),
    ("rdf", None),
    ("facebook", None),
    ("bluesky", None),
    ("mastodon", None),
    ("update", None),
    ("summary", "text_only"),
    ("readability", "text_only"),
    ("null", "any"),
)

# --- fixed values: a type is not built when an original file matches one of these -----------
EXCLUSION_GLOBS = {
    "epub.images": ("epub.dp",),
    "epub.noimages": ("epub.dp",),
    "html.noimages": ("html/*",),
}

# --- fixed values: output file names ---------------------------------------------------------
OUTPUT_NAMES = {
    "html.noimages": "pg{id}.html",
    "html.images": "pg{id}-images.html",
    "epub.noimages": "pg{id}.epub",
    "epub.images": "pg{id}-images.epub",
    "epub3.images": "pg{id}-images-3.epub",
    "kindle.noimages": "pg{id}.mobi",
    "kindle.images": "pg{id}-images.mobi",
    "kf8.images": "pg{id}-images-kf8.mobi",
    "pdf.noimages": "pg{id}.pdf",
    "pdf.images": "pg{id}-images.pdf",
    "txt.utf-8": "pg{id}.txt",
    "rdf": "pg{id}.rdf",
    "rst.gen": "pg{id}.rst",
    "cover.small": "pg{id}.cover.small.jpg",
    "cover.medium": "pg{id}.cover.medium.jpg",
    "qrcode": "pg{id}.qrcode.png",
    "zip": "pg{id}-h.zip",
    "logfile": "pg{id}.converter.log",
}
GENERIC_OUTPUT_NAME = "pg{id}.generic"

# --- fixed values: what a requested target pulls in ------------------------------------------
TARGET_PARTS = {
    "everything": ("all", "kindle.noimages", "facebook", "bluesky", "mastodon", "update", "summary"),
    "all": ("html", "epub", "kindle", "epub3", "kf8", "pdf", "txt", "rst", "cover", "qrcode", "rdf", "readability"),
    "html": ("html.images",),
    "epub": ("epub.images", "epub.noimages"),
    "epub3": ("epub3.images",),
    "kindle": ("kindle.images",),
    "kf8": ("kf8.images",),
    "pdf": ("pdf.images",),
    "txt": ("txt.utf-8", "txt.iso-8859-1", "txt.us-ascii"),
    "rst": ("rst.gen",),
    "kindle.noimages": ("epub.noimages",),
    "kindle.images": ("epub.images",),
    "html.images": ("picsdir.images",),
    "pdf.noimages": ("picsdir.noimages",),
    "pdf.images": ("picsdir.images",),
    "rst.gen": ("picsdir.images",),
    "cover": ("cover.medium", "cover.small"),
}

# --- fixed values: largest source per type family, MiB ---------------------------------------
SOURCE_CAP_MIB = {"epub": 16, "epub3": 16, "kindle": 16, "kf8": 16}
SOURCE_CAP_OTHER_MIB = 32

# --- fixed values: extensions with a readable header, best metadata first --------------------
PARSEABLE_EXTENSIONS = (".rst", ".html", ".htm", ".tex", ".txt")
HTML_EXTENSIONS = (".html", ".htm", ".xhtml")

# --- fixed values: ids with a special meaning ------------------------------------------------
DUMMY_BOOK = 99999
HTML_PREFIX_FROM = 10000
MISSING_ON_DISK = 5

# --- fixed values: attribute codes -----------------------------------------------------------
TITLE_CODE = 245
CREDIT_CODE = 508
FIXED_008_TAIL = "utu|||||o|||||||||||||| d"
SUMMARY_CODE = 520
NOTE_CODE = 500
IMPRINT_CODE = 260
PUBLISHED_CODE = 906
SCORE_CODE = 908

# --- fixed values: changelog statements and the ids inside them ------------------------------
AUTHOR_UPDATE_PREFIX = "update mn_books_authors "
AUTHOR_DELETE_PREFIX = "delete from mn_books_authors "
AUTHOR_INSERT_PREFIX = "insert into mn_books_authors (fk_books,"
TITLE_UPDATE_PREFIX = 'update attributes set  "fk_attriblist" = 245'
AUTHOR_BOOK_PATTERN = r"fk_books = (\d\d+)"
INSERT_BOOK_PATTERN = r"values \((\d\d+),"
TITLE_PK_PATTERN = r"where pk = (\d\d+)"

# --- fixed values: readability bands (from, grade, description), highest first ---------------
SCORE_BANDS = (
    (90, "5th grade", "Very easy to read."),
    (80, "6th grade", "Easy to read."),
    (70, "7th grade", "Fairly easy to read."),
    (60, "8th & 9th grade", "Neither easy nor difficult to read."),
    (50, "10th to 12th grade", "Somewhat difficult to read."),
    (30, "College-level", "Difficult to read."),
    (10, "College graduate level", "Very difficult to read."),
    (0, "Professional level", "Extremely difficult to read."),
)
SCORED_LANGUAGES = ("en", "de", "es", "fr", "it", "nl", "ru", "hu")

# --- fixed values: published reading-ease formulas: base, per words/sentence, per syllables/word
# en Flesch 1948; de Amstad 1978; fr Kandel & Moles 1958; es Fernandez Huerta 1959;
# it, nl, ru in the forms in common use. No checked source for hu: no score.
EASE_FORMULAS = {
    "en": (206.835, 1.015, 84.6),
    "de": (180.0, 1.0, 58.5),
    "es": (206.84, 1.02, 60.0),
    "fr": (207.0, 1.015, 73.6),
    "it": (217.0, 1.3, 60.0),
    "nl": (206.835, 0.93, 77.0),
    "ru": (206.835, 1.3, 60.1),
}
WORD_PATTERN = r"\p{L}+"
SENTENCE_PATTERN = r"[.!?]+"
# vowels one by one: single Latin-1 letters are looked up in a bit set, ranges are not
LATIN_VOWELS = "AEIOUYaeiouyÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜÝàáâãäåæèéêëìíîïòóôõöøùúûüýÿŐ-œŰű"
CYRILLIC_VOWELS = "ЁАЕИОУЫЭЮЯаеиоуыэюяё"
SYLLABLE_PATTERN = f"[{LATIN_VOWELS}]+"
CYRILLIC_SYLLABLE_PATTERN = f"[{LATIN_VOWELS}{CYRILLIC_VOWELS}]+"

# --- fixed values: summaries and encyclopedia links ------------------------------------------
MODEL_TAG = " (This is an automatically generated summary.)"
WIKI_TAG = " (This summary is from Wikipedia.)"
WIKI_CAPTION = "Wikipedia page about this book"
WIKI_LINK_PATTERN = r"(?i)https?://([a-z]{2,3})\.wikipedia\.org/wiki/([/!@i^*$a-z0-9_\(\)-]+)"
WIKI_SKIPPED_LANGUAGES = ("sco",)
WIKI_SKIPPED_TITLES = ("simple.", "File:", "/Category:", "(disambiguation)")
REFUSAL_STARTS = ("It appears", "It seems")
REFUSAL_PHRASES = ("no content provided", "no content has been provided")
OPENING_TOKENS = 24000

# --- fixed values: announcements -------------------------------------------------------------
POST_FROM = {"Facebook": 45000, "Bluesky": 75000, "Mastodon": 70800}
POST_TITLE_ROOM = {"Bluesky": 300 - 84, "Mastodon": 500 - 84}
BACKLOG_CURSORS = {
    "Bluesky": ("2025-01-07 12:00:00", 75000),
    "Facebook": ("2019-06-05 09:00:00", 59291),
}
BACKLOG_SECONDS = 7200
BACKLOG_PER_DAY = 12
BOOKS_PER_DAY = 2600

# --- fixed values: log reports ---------------------------------------------------------------
LOG_PHRASES = {
    "critical": "CRITICAL",
    "error": "ERROR",
    "failures": "Failed",
    "whitewash": "This is an ERROR for white-washed files",
}
LOG_CONTEXT_LINES = 2
CONTEXT_REPORTS = ("whitewash",)

# --- fixed values: image log -----------------------------------------------------------------
IMAGE_LOG_COLUMNS = ("datetime", "src", "img_id", "alt_txt", "rel_url", "in_a_figure")
IMAGE_COLUMNS = ("item", "img_id", "alt_txt", "img_url", "in_a_figure", "x", "y", "len", "hash")
IMAGE_ITEM_PATTERN = r"files/(\d+)/"
ALT_TEXT_CHARS = 2000

# --- fixed values: catalog feed header -------------------------------------------------------
CATALOG_COLUMNS = ("Text#", "Type", "Issued", "Title", "Language", "Authors", "Subjects", "LoCC", "Bookshelves")
