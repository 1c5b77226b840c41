"""Line classification patterns.

Written with explicit Unicode classes so Java regex (Spark) and RE2
(DuckDB, used by the SQL oracle) give the answers Python's Unicode
``\\s \\w \\d`` give.  Lines never contain a line terminator (they are
split on all of them), so ``$`` behaves the same in every engine.
"""

# ---------------------------------------------------------------------------
# These must equal the reference behaviour for right results.
# ---------------------------------------------------------------------------
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"          # Python str.isspace()
WC = r"[\p{L}\p{N}_]"                        # Python \w
ND = r"\p{Nd}"                               # Python \d

LINEBREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"   # str.splitlines()
LINEBREAK_CHARS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"          # the same, one char each
BLANK = rf"^{WS}*$"
CONT = r"^[a-z]"
EXHIBIT = r"^\x{FEFF}?Exhibit."
TITLE = r"^\x{FEFF}?[\p{L}\p{N}_ ]"
SECTION = r"^[A-Z][a-z ]+[^.]?$"
EXACT = rf"^(Section.*|[A-Z ]+|{ND}+\.{WS}*[A-Z ]+)$"
LIST = rf"^{WS}*({ND}+[.)]|{WC}[.)]|\({WC}+\)|[•*-])"
SINGLENUM = rf"^{WS}*[\p{{Nd}}.)]+{WS}*$"
UPPER_HAS = r"\p{IsUppercase}"
UPPER_NOT = r"[\p{IsLowercase}\p{IsTitlecase}]"
TRAILING_WS = rf"{WS}+$"
EDGE_WS = rf"^{WS}+|{WS}+$"

# List marker classes, tried in this order; group 1 is the content.
LIST_CLASS_NUMBER = rf"^({ND}+)\.?\)?"
LIST_CLASS_LETTER = rf"^({WC}+)\.?\)"
LIST_CLASS_PAREN = rf"^\(({WC}+)\)"
LIST_CLASS_BULLET = r"^(•|-|\*)"

# Tag names.
TAG_TITLE, TAG_SECTION, TAG_LIST, TAG_LIST_ITEM, TAG_PLAIN = "title", "s", "l", "le", "p"

# The 32 ASCII punctuation marks (Python string.punctuation).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Characters the sequence tokenizer turns into blanks (apostrophe kept).
SEQ_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"
# Characters removed by the section-text cleaner.
CLEAN_CHARS = "\\'\""
# Default word token: runs of two or more word characters.
WORD2 = r"[\p{L}\p{N}_]{2,}"
NON_WORD = r"[^\p{L}\p{N}_]+"
