"""Constants of the layout rules.  All values here are fixed: they decide which results are right."""

#: Unicode blanks, as a character class of Java and RE2.
BLANK = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Words that head a caption.
CAPTION_WORDS = "Fig(?:ure)?|Scheme|Table|Chart"

# What may stand before a section name.
APPENDIX_PREFIX = rf"^(\p{{Nd}}{{1,3}}\.{BLANK}*|appendix{BLANK}+[a-z]\.?{BLANK}*)"

# Standard section names.
SECTION_NAMES = [
    "introduction",
    "background",
    "results",
    "results and discussion",
    "discussion",
    "methods",
    "materials and methods",
    "experimental",
    "experimental section",
    "experimental details",
    "experimental part",
    "conclusion",
    "conclusions",
    "summary",
    "outlook",
    "acknowledgment",
    "acknowledgments",
    "acknowledgement",
    "acknowledgements",
    "reference",
    "references",
    "bibliography",
    "notes",
    "notes and references",
    "author contribution",
    "author contributions",
    "credit authorship contribution statement",
    "author information",
    "associated content",
    "corresponding author",
    "author",
    "authors",
    "data availability",
    "data availability statement",
    "competing interest",
    "competing interests",
    "declaration of competing interest",
    "declaration of competing interests",
    "conflict of interest",
    "conflict of interests",
    "conflicts of interest",
    "conflicts of interests",
    "declaration of interest",
    "declaration of interests",
    "supporting information",
    "supplementary information",
    "supplementary material",
    "supplementary materials",
    "supplementary data",
    "abbreviations",
    "funding",
    "abstract",
]
TOP_LEVEL_NAMES = "|".join(n.replace(" ", f"{BLANK}+") for n in SECTION_NAMES)

# Terms set in another style inside chemical headings.
CHEMISTRY_TERMS = ["tert", "sec", "n", "iso", "neo", "cis", "trans", "ortho", "meta", "para", "syn", "anti", "endo", "exo", "threo", "erythro", "rac", "meso", "R", "S", "E", "Z", "Ra", "Sa", "Rp", "Sp", "in situ", "in vitro", "in vivo", "et al", "vs"]

# Thresholds.
HEADER_SHARE = 0.05
FOOTER_SHARE = 0.05
REPEAT_SHARE = 0.3
REPEAT_LEAST = 2
LARGER = 1.02
RELAXED = 0.98
HEADING_LENGTH = 120
HEADING_WORDS = 20
LEVELS = 6
BLOCKS_LARGER = 2
BLOCKS_RELAXED = 4
DEBRIS_WORDS = 8
DEBRIS_HEADING = 2
COLUMN_GAP = 0.08
COLUMN_LEAST, COLUMN_MOST = 0.2, 0.8
COLUMN_BLOCKS = 4
IN_FIGURE = 0.4
SAME_SIZE = 0.5
MARKER_SIZE = 2.0
MARKER_LENGTH = 2
DEFAULT_SIZE = 10.0
PAD_X, PAD_Y = 8.0, 25.0
FIGURE_AREA = 2000.0
WHITE = 0.02
BOLD_BIT = 16
