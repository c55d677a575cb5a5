"""Patterns, character classes and word lists that decide results.

Everything below the "fixed values" markers has to keep its exact value: the filters, flags, token
counts and scores are defined by it.  The patterns are written for ``java.util.regex`` with explicit
character classes, so that they mean the same on every Java release and do not need the (slower)
Unicode-class flag:

* ``WS``    every character that Python's ``str.isspace`` accepts,
* ``DIGIT`` every decimal digit of any script,
* ``WORD``  letters, numbers and the underscore.
"""

from __future__ import annotations

from functools import lru_cache

# One range test rejects most characters before the rare blanks above Latin-1 are looked at.
WS_RANGES = (
    r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
WS = f"[{WS_RANGES}]"
NOT_WS = f"[^{WS_RANGES}]"
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"
CJK_RANGE = r"\x{4e00}-\x{9fff}"
ALNUM = rf"[\p{{L}}\p{{N}}{CJK_RANGE}]"
# A word boundary spelled out, because Java changed the meaning of \b between releases.
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# --- fixed values -------------------------------------------------------------------------------
VALID_SOURCES = ["web", "document", "code", "instruction"]
VALID_LANGUAGES = ["zh", "en", "mixed", "code", "unknown"]
METADATA_DEFAULTS = {"url": "", "title": "", "parser": "", "version": "clean_v1"}
PARSER_HTML = "beautifulsoup_html"
PARSER_PLAIN = "plain_text"
PARSER_DOCUMENT = "document_plain_text"
PARSER_CODE = "code_plain_text"
PARSER_INSTRUCTION = "instruction_template"
SKIPPED_TAGS = ["script", "style", "nav", "footer", "noscript", "header"]

# A pattern that opens with a plain class or a look-ahead for one is skipped quickly at most positions;
# these openings only rule out impossible starts (\x{17f} and \x{212a} are the other cases of s and k).
URL = rf"(?=[hHwW][tTwW])(?iu:https?://{NOT_WS}+|www\.{NOT_WS}+)"
EMAIL = EDGE + r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}" + EDGE
PHONE = (
    rf"(?=[+{DIGIT}])(?<!{DIGIT})(?:\+?{DIGIT}{{1,3}}[-{WS_RANGES}]?)?"
    rf"(?:1[3-9]{DIGIT}{{9}}|{DIGIT}{{3}}[-.{WS_RANGES}]?{DIGIT}{{3}}[-.{WS_RANGES}]?{DIGIT}{{4}})(?!{DIGIT})"
)
# 15 digits, or 17 digits and a digit or X.
ID_CARD = rf"{DIGIT}(?<!{DIGIT}{DIGIT}){DIGIT}{{14}}(?:{DIGIT}{{2}}[{DIGIT}Xx])?(?!{DIGIT})"
API_KEY = (
    r"(?=[aAsS\x{17f}tTpP][pPcCeEoOaAkK\x{212a}])"
    rf"(?iu:(?:api[_-]?key|access[_-]?key|secret|token|password){WS}*[:=]{WS}*['\"]?[A-Za-z0-9_\-]{{8,}}"
    r"|sk-[A-Za-z0-9_\-]{10,})"
)
# Every match of API_KEY has one of these.
API_KEY_MARKS = [":", "=", "k-", "K-", "\N{KELVIN SIGN}-"]
SENSITIVE = (
    rf"(?=[pPsSaAbB\x{{17f}}][aAeEpPcC])(?<!{WORD})"
    rf"(?iu:password|secret|api[_-]?key|access[_-]?token|bearer{WS}+[A-Za-z0-9_\-.]+){EDGE}"
)
PII_FLAGS = ["email", "phone", "id_card", "api_key", "sensitive_keyword"]

CODE_SYMBOLS = r"{}[]();=<>+-*/_%:\`|&^~#$"
CODE_KEYWORDS = [
    "def", "class", "import", "return", "for", "while", "if", "else", "try", "except", "function",
    "const", "let", "var",
]

TOKEN = rf"[{CJK_RANGE}]|[A-Za-z_]+(?:'[A-Za-z]+)?|{DIGIT}+(?:\.{DIGIT}+)?|{NOT_WS}"
# The tokens of TOKEN that can be longer than one character.
LONG_TOKEN = rf"[A-Za-z_{DIGIT}](?:(?<=[A-Za-z_])[A-Za-z_]*(?:'[A-Za-z]+)?|(?<={DIGIT}){DIGIT}*(?:\.{DIGIT}+)?)"
SIMHASH_TOKEN = rf"{WORD}+|[^\p{{L}}\p{{N}}_{WS_RANGES}]"

LENGTH_BUCKETS = [(32, "0-32"), (128, "33-128"), (512, "129-512"), (2048, "513-2048"), (None, "2049+")]
FILTER_REASONS = ["empty_text", "too_short", "too_long", "too_many_urls", "repeated_chars", "pii_detected", "low_information"]
QUALITY_BUCKETS = [(0.75, "high"), (0.45, "medium"), (None, "low")]
# --- end of fixed values ------------------------------------------------------------------------

CODE_SYMBOL_CLASS = "[" + "".join("\\" + c for c in CODE_SYMBOLS if c != "_") + "_]"
CODE_KEYWORD = rf"(?=[dcirfwetlv][elmohfxrua])(?<!{WORD})(?:{'|'.join(CODE_KEYWORDS)})(?!{WORD})"


@lru_cache(maxsize=None)
def digit_class() -> str:
    """Decimal digits of any script plus the digit-valued signs (superscripts, circled digits, ...)."""
    extra = [c for c in range(0x110000) if chr(c).isdigit() and not chr(c).isdecimal()]
    ranges: list[list[int]] = []
    for c in extra:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + DIGIT + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"
