"""Secrets in texts: fixed patterns, and strings that a tokenizer cannot shorten.

A vocabulary trained on text spends few tokens on words and many on random strings, so a
long string with few characters per token is likely a key.  A candidate is judged whole
and, if it is not taken whole, by its pieces between separators.  Digests (known by their
length), UUIDs, numbers, repetitions of a short string and names whose every piece the
vocabulary encodes in few tokens are left out; all else the characters per token decide.

Null and empty texts have no spans; repeated rows are scanned alike; other columns pass
through; a column that is already called ``spans`` is replaced; an empty table stays so.
The work grows with the length of a text, also where it is full of spans; overlapping spans
of several kinds all stay, and a token string never overlaps a base span.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.registry import query
from runlens.llm.shared import load
from runlens.llm.spans import Span, Taken, add_spans, count_of, cut_spans, joined

KINDS = ("assign", "access", "hex", "token")

#: Fewest characters of a candidate, and most characters per token of a random string.
MIN_CHARS = 16
MAX_CHARS_PER_TOKEN = 2.2

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 16 or more are the runs that pass; shorter ones fail and leave nothing.
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
SEPARATOR = re.compile(r"[_/=+-]+")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
REPEATED = re.compile(r"(.{1,%d}?)\1+" % (MIN_CHARS - 1))

# Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 (fixed values).
DIGESTS = {32, 40, 56, 64, 96, 128}

#: Any text with a span holds one of these.
HINT = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]"""
    r"""|[A-Za-z0-9+/_=-]{16}"""
)


def digest(text: str) -> bool:
    """Whether a string has the digits and the length of a known digest."""
    return len(text) in DIGESTS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) is not None


def named(candidate: str, vocabulary) -> bool:
    """Whether every piece is a word of few tokens, a short number or a digest.

    One or two letters are a word only between separators: random strings are full of them.
    """

    def word(piece: str, part: str) -> bool:
        if len(piece) <= (4 if piece.isdigit() else 2 * (piece == part)):
            return True
        return len(piece) >= MAX_CHARS_PER_TOKEN * len(vocabulary.encode_ordinary(piece))

    return all(
        digest(part) or all(word(piece, part) for piece in PIECE.findall(part))
        for part in SEPARATOR.split(candidate)
    )


def unlikely(candidate: str, vocabulary) -> bool:
    """Whether a string has few characters per token and no known reason for it."""
    return (
        any(c.isalpha() for c in candidate)
        and UUID.fullmatch(candidate) is None
        and REPEATED.fullmatch(candidate) is None
        and len(candidate) < MAX_CHARS_PER_TOKEN * len(vocabulary.encode_ordinary(candidate))
        and not named(candidate, vocabulary)
    )


_encodings: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a file of ranks, once per Python worker."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # The split of that vocabulary (fixed value).
        pattern = (
            r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        )
        _encodings[path] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


def secret_spans(text: str, vocabulary) -> list[Span]:
    """Base spans of a text and, apart from them, its token-inefficient strings."""
    spans: list[Span] = [
        ("assign", m.start(), m.end(), True) for m in ASSIGN.finditer(text) if len(m[2]) >= 12
    ]
    spans += [
        ("access", m.start(), m.end(), True)
        for m in ACCESS.finditer(text)
        if m.end() - m.start() >= 18
    ]
    spans += [("hex", m.start(), m.end(), True) for m in HEX.finditer(text)]
    free = Taken(spans).free
    for m in CANDIDATE.finditer(text):
        places = [(m.start(), m.end())]
        if not (free(*places[0]) and unlikely(m[0], vocabulary)):
            places = [p for p in parts(text, m.start(), m.end()) if free(*p)]
            places = [(s, e) for s, e in places if unlikely(text[s:e], vocabulary)]
        spans += [("token", s, e, False) for s, e in places]
    return spans


def parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Places of the pieces between separators that are long enough for a candidate."""
    cuts = [(start, start), *(m.span() for m in SEPARATOR.finditer(text, start, end)), (end, end)]
    found = [(a, b) for (_, a), (b, _) in zip(cuts, cuts[1:]) if b - a >= MIN_CHARS]
    return [] if found == [(start, end)] else found


def leaks(text: str, spans: list[Span]) -> list[Span]:
    """The spans to take out: all, but for hex that is one character over and over."""
    return [s for s in spans if s[0] != "hex" or len(set(text[s[1] : s[2]])) > 1]


def scan_secrets(
    df: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    leaks_only: bool = False,
    column: str = "spans",
) -> DataFrame:
    """Add the column of spans; ``vocabulary`` is a file of ranks."""
    return add_spans(df, text_col, _maker(vocabulary, leaks_only), column)


def _maker(vocabulary: str, leaks_only: bool):
    def maker():
        def test(texts: pa.Array) -> pa.Array:
            return pc.match_substring_regex(texts, HINT).fill_null(False)

        def find(text: str) -> list[Span]:
            spans = secret_spans(text, encoding(vocabulary))
            return leaks(text, spans) if leaks_only else spans

        return test, find

    return maker


def redact_secrets(
    df: DataFrame, vocabulary: str, text_col: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """The same rows and columns with every secret in the text replaced by ``mark``.

    Digests and numbers that the base pattern ``hex`` finds go too: a key of 32 or 64 hex
    digits looks the same.  Only one digit repeated (a row of zeros) is no secret and stays.
    """
    return cut_spans(df, text_col, _maker(vocabulary, True), mark)


@query("op6_secret_tokens")
def op6_secret_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    documents = load(spark, folder, "documents").select("doc_id", "text")
    found = scan_secrets(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select(
        "doc_id",
        count_of("assign").alias("n_assign"),
        count_of("access").alias("n_access"),
        count_of("hex").alias("n_hex"),
        F.sha2(joined(KINDS, False, True).cast("binary"), 256).alias("base_sha256"),
        joined(KINDS, False, False).alias("spans"),
    )
