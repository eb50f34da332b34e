"""Secrets in text: three exact patterns, and strings that a primed compressor finds new.

A candidate is a long token that stands near a sensitive word, before or after it. Its marginal size is the
zstandard size of context and candidate less the size of the context alone, with a dictionary as
prefix: text that repeats its surroundings or the dictionary costs few bytes, a key costs almost
all of its own. Candidates that cost at least ``bits`` bits a character are new.

The dictionary holds common identifiers and the corpus's own long tokens: those that stand in
several contexts without a sensitive word. A key in use stands near such words, however many
copies of its text there are, so it does not get in. It is counted over all texts; the most
frequent ones, a bounded number, prime the compressor.

What is new to the dictionary may still be a rare word or a path. A vocabulary of byte pairs tells
them apart: words fall into few long pieces, keys into many short ones. New candidates of fewer
than ``plain`` characters a piece are reported as ``novel``.

Each text is handled whole and alone, in Arrow batches; only long tokens are shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship, with_fields

# The exact patterns.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of at least 32: shorter runs fail the length anyway, and a run is taken whole either way.
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "novel")

# Words near which a long token is looked at.
CONTEXT_WORDS = re.compile(
    r"password|passwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth",
    re.IGNORECASE | re.ASCII,
)
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST},}}")

# Text that code and configuration are full of; what looks like it is no secret.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key client_secret client_id "
    "access_token refresh_token id_token bearer authorization authentication credentials username user_name "
    "session_id request_id response config configuration settings environment variable default example "
    "localhost http://www. https://api. .com/ .org/ .example.com index.html application/json text/plain "
    "import from return function class public static void string integer boolean null none true false "
    "def self.__init__ get_token set_password get_secret os.environ getenv System.getProperty process.env "
    "your_password_here your-api-key changeme placeholder xxxxxxxxxxxxxxxx 0000000000000000 1234567890 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ ________________ ---------------- ================"
)

# Long words of plain prose, so that they cost few bytes even in a corpus that lacks them.
LONG_WORDS = (
    "internationalization internationalisation characterization misunderstanding notwithstanding telecommunications "
    "counterproductive extraordinarily disproportionately environmentally acknowledgements responsibilities "
    "recommendations representatives characteristics straightforward interdisciplinary administrators "
    "misinterpretation experimentation industrialization organizational transformations commercialization "
    "Geschwindigkeitsbegrenzung Verantwortungsbewusstsein Wissenschaftlerinnen Datenschutzerklärung "
    "Benutzeroberfläche Auseinandersetzung Zusammenarbeit Lebensversicherungsgesellschaft Arbeitsgemeinschaft "
    "anticonstitutionnellement internationalement gouvernementales professionnellement caractéristiques "
    "administrativement exceptionnellement particulièrement desafortunadamente extraordinariamente "
    "responsabilidades internacionalmente características administraciones electrodomésticos "
)

WORDS = re.compile(r"[A-Za-z]+|[0-9]")
RANKS_BYTES = 16 << 20


def prime(familiar: Sequence[str] = ()) -> bytes:
    """The dictionary: familiar tokens, the most frequent one last, then long words and identifiers."""
    return " ".join([*reversed(familiar), LONG_WORDS + IDENTIFIERS]).encode()


@lru_cache(4)
def compressor(level: int, dictionary: bytes) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False)


def marginal_bits(context: str, candidate: str, dictionary: bytes, level: int = 9) -> float:
    """Bits a character that the candidate adds to its compressed context."""
    pack = compressor(level, dictionary).compress
    before = context.encode("utf-8", "surrogatepass")
    return 8 * (len(pack(before + candidate.encode())) - len(pack(before))) / len(candidate)


def read_ranks(path: str, most_bytes: int = RANKS_BYTES) -> bytes:
    """A vocabulary file of byte pairs; one of more than ``most_bytes`` is refused."""
    with open(path, "rb") as f:
        content = f.read(most_bytes + 1)
    if len(content) > most_bytes:
        raise ValueError(f"the vocabulary file is larger than {most_bytes} bytes")
    return content


@lru_cache(2)
def vocabulary(ranks: bytes) -> tiktoken.Encoding:
    """The vocabulary, read once in each Python worker."""
    pairs = (line.split() for line in ranks.splitlines())
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=merges, special_tokens={})


def piece_length(token: str, ranks: bytes) -> float:
    """Characters a piece of the token's words, each as it stands or in lower case, whichever takes fewer pieces.

    Digits are pieces of their own; other characters part words and do not count.
    """
    pieces = vocabulary(ranks).encode_ordinary
    words = WORDS.findall(token)
    count = sum(min(len(pieces(word)), len(pieces(" " + word.lower()))) for word in words)
    return sum(map(len, words)) / count if count else float("inf")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the exact patterns, leftmost and non-overlapping for each kind."""
    low = text.lower()
    out = []
    if any(word in low for word in SENSITIVE):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=order)


def order(span: tuple[str, int, int]):
    return span[1], KINDS.index(span[0]), span[2]


def candidates(text: str, reach: int) -> list[tuple[int, int]]:
    """Long tokens that begin within ``reach`` characters after a sensitive word or end so before one."""
    out, done = [], 0
    words = [word.span() for word in CONTEXT_WORDS.finditer(text)]
    for _, end in words:
        at, stop = max(end, done), end + reach
        # The search ends where a token of least length can no longer begin in reach.
        while near := CANDIDATE.search(text, at, max(at, stop + LEAST)):
            at = done = CANDIDATE.match(text, near.start()).end()
            out.append((near.start(), at))
    # Before a word: what the search after words has not taken.
    after, starts, i = [*out, (len(text), len(text))], [start for start, _ in words], 0
    for token in CANDIDATE.finditer(text) if words else ():
        start, end = token.span()
        while after[i][1] <= start and i < len(after) - 1:
            i += 1
        # A sensitive word within the token ends it.
        next_word = bisect_left(starts, start)
        if next_word == len(starts) or starts[next_word] - end > reach:
            continue
        end = min(end, starts[next_word])
        if end - start >= LEAST and after[i][0] >= end:
            out.append((start, end))
    return sorted(out)


def novel_spans(
    text: str,
    reach: int,
    around: int,
    bits: float,
    dictionary: bytes = prime(),
    ranks: bytes | None = None,
    plain: float = 3.0,
) -> list[tuple[str, int, int]]:
    """Incompressible tokens within ``reach`` characters of a sensitive word, on either side."""
    out = []
    for start, end in candidates(text, reach):
        token = text[start:end].rstrip(".=-")
        if len(token) < LEAST:
            continue
        context = text[max(0, start - around) : start] + text[end : end + around]
        if marginal_bits(context, token, dictionary) >= bits and (ranks is None or piece_length(token, ranks) < plain):
            out.append(("novel", start, start + len(token)))
    return out


def uses(text: str | None, reach: int) -> set[tuple[str, str]]:
    """Long tokens without a sensitive word near them, each with the characters before it."""
    text = text or ""
    near, i, out = candidates(text, reach), 0, set()
    for token in CANDIDATE.finditer(text):
        start, end = token.span()
        while i < len(near) and near[i][1] <= start:
            i += 1
        if i == len(near) or near[i][0] >= end:
            out.add((token[0].rstrip(".=-")[:LONGEST], text[max(0, start - BEFORE) : start]))
    return {(token, before) for token, before in out if len(token) >= LEAST}


# Characters of a token that go into the dictionary; characters that tell two of its contexts apart.
LONGEST, BEFORE = 64, 12


def familiar_tokens(df: DataFrame, text: str = "text", reach: int = 40, contexts: int = 3, most: int = 2000) -> DataFrame:
    """``token`` and ``n``: long tokens in at least ``contexts`` contexts without a sensitive word, the ``most`` frequent.

    A context is the few characters before the token, so copies of a text count once. Tokens are
    counted over all texts; ties go to the smaller token. Null and empty texts have no tokens.
    """
    ship(df.sparkSession)

    def use_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set().union(*(uses(value, reach) for value in batch["text"]))
            yield pd.DataFrame([(t, hashlib.sha256(b.encode("utf-8", "surrogatepass")).digest()[:8]) for t, b in found], columns=["token", "before"])

    used = df.select(F.col(f"`{text}`").alias("text")).mapInPandas(use_batches, "token string, before binary")
    counts = used.distinct().groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= contexts).orderBy(F.desc("n"), "token").limit(most)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_text(
    text: str | None,
    reach: int = 40,
    around: int = 256,
    bits: float = 4.5,
    dictionary: bytes = prime(),
    ranks: bytes | None = None,
    plain: float = 3.0,
):
    """The fields of one text."""
    text = text or ""
    base = base_spans(text)
    kinds = [kind for kind, _, _ in base]
    spans = sorted({*base, *novel_spans(text, reach, around, bits, dictionary, ranks, plain)}, key=order)
    return (
        kinds.count("assign"),
        kinds.count("access"),
        kinds.count("hex"),
        hashlib.sha256(joined(base).encode()).hexdigest(),
        joined(spans),
    )


def scan(
    df: DataFrame,
    text: str = "text",
    reach: int = 40,
    around: int = 256,
    bits: float = 4.5,
    ranks_file: str | None = None,
    plain: float = 3.0,
    contexts: int = 3,
    most: int = 2000,
) -> DataFrame:
    """Append the secrets of a text.

    ``n_assign``, ``n_access``, ``n_hex``: matches of the exact patterns; ``base_sha256``: digest
    of their spans; ``spans``: all spans as ``kind:start:end`` by start, then kind (code points,
    end exclusive). ``reach``: characters between a sensitive word and a candidate; ``around``:
    characters of context on each side; ``bits``: least marginal bits a character; ``contexts`` and
    ``most``: as in ``familiar_tokens``, whose tokens (at most 65 ``most`` bytes) come to the driver;
    ``ranks_file``: a vocabulary of byte pairs, without which rare words count as new;
    ``plain``: characters a piece from which a token is words.

    A null text counts as empty: no spans, the digest of the empty string. Rows are never dropped
    or joined, so repeated rows stay. Columns with a name of the output are replaced.
    """
    ship(df.sparkSession)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    familiar = familiar_tokens(df, text, reach, contexts, most)
    known = df.sparkSession.sparkContext.broadcast(
        (prime([row["token"] for row in familiar.collect()]), read_ranks(ranks_file) if ranks_file else None)
    )

    def scan_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([scan_text(value, reach, around, bits, *known.value, plain) for value in texts], columns=names)

    scanned = F.pandas_udf(scan_batches, FIELDS)
    return with_fields(df, scanned(F.col(f"`{text}`")), names)
