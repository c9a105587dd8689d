"""Line-first quality rules.

Lines are judged one by one: navigation bars, boilerplate, symbol noise, runs of one word, lines seen before and
fragments without a sentence end fail and are taken out. A document is then rejected if too little is left of it,
or if it fails the base rules on the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.common import batches_of, grams, hash_words, text_words, tidy

WINDOW = 8
WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
NOISE = re.compile(r"[#*$%&]{3}")
SENTENCE_END = re.compile("[.!?…。！？][\"'”’»)\\]]*$")
# Phrases of page furniture in English, French, German and Spanish.
BOILERPLATE = re.compile(
    r"(?i)\b(?:accept (?:all )?cookies|cookie policy|privacy policy|terms of (?:use|service)|all rights reserved"
    r"|enable javascript|lorem ipsum|sign up for our newsletter|click here to|skip to (?:main )?content"
    r"|accepter (?:tous )?les cookies|politique de cookies|conditions d'utilisation|mentions l[ée]gales|tous droits r[ée]serv[ée]s"
    r"|activer javascript|cliquez ici pour|aller au contenu"
    r"|(?:alle )?cookies akzeptieren|datenschutzerkl[äa]rung|nutzungsbedingungen|alle rechte vorbehalten"
    r"|javascript aktivieren|newsletter abonnieren|klicken sie hier|zum inhalt springen"
    r"|aceptar (?:todas )?las cookies|pol[ií]tica de (?:privacidad|cookies)|t[ée]rminos (?:de uso|del servicio)"
    r"|todos los derechos reservados|habilitar javascript|haga clic en|saltar al contenido)\b"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of what a document may lose."""

    min_words: int = 20
    max_repeat_percent: int = 30
    fragment_words: int = 4  # a line without a sentence end needs as many words
    bars: float = 0.2  # bars per word of a navigation line
    noise: float = 0.3  # words with a run of symbols, as a part of the line
    repeats: float = 0.5  # words equal to the one before, as a part of the line
    lost: float = 0.5  # a document that loses more of its word characters is rejected


def line_verdict(line: str, words: list[str], seen: bool, rules: Rules) -> str:
    """Why a line with words fails, or an empty string."""
    if seen:
        return "duplicate"
    n = len(words)
    if sum(w == "|" for w in words) >= max(2, rules.bars * n):
        return "navigation"
    if len(NOISE.findall(line)) > rules.noise * n:
        return "symbols"
    if n >= 4 and sum(map(str.__eq__, words, words[1:])) > rules.repeats * n:
        return "repeats"
    if BOILERPLATE.search(line):
        return "boilerplate"
    if n < rules.fragment_words and not SENTENCE_END.search(line.rstrip()):
        return "fragment"
    return ""


def judge(text: str, hashes: np.ndarray, rules: Rules) -> tuple:
    """Counts and verdict of one text whose words have these hashes; the cleaned text is last."""
    seen: set[str] = set()
    n_dup, total, left, kept_lines = 0, 0, 0, []
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            kept_lines.append(line)
            continue
        repeated = line in seen
        seen.add(line)
        n_dup += repeated
        chars = sum(map(len, words))
        total += chars
        if not line_verdict(line, words, repeated, rules):
            left += chars
            kept_lines.append(line)
    n = len(hashes)
    repeats = repeated_words(hashes)
    base_failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not base_failed and total - left <= rules.lost * total
    return n, total, len(SYMBOL.findall(text)), n_dup, repeats, base_failed, kept, "\n".join(kept_lines)


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that are found more than once."""
    found = grams(hashes, window)
    if not len(found):
        return 0
    _, which, counts = np.unique(found, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[which] > 1)
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def _run(rules: Rules, with_text: bool):
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
        names = [part.split()[0] for part in COLUMNS.split(", ")] + ["cleaned"]
        for batch in batches_of(rows):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            buf, starts, ends, offsets = text_words([t.encode() for t in texts])
            hashes = hash_words(buf, starts, ends)
            out = [judge(t, hashes[a:b], rules) for t, a, b in zip(texts, offsets, offsets[1:], strict=False)]
            columns = [batch.column("doc_id")]
            columns += [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            size = len(names) if with_text else len(names) - 1
            yield pa.RecordBatch.from_arrays(columns[:size], names=names[:size])

    return run


def quality_rules(docs: DataFrame, rules: Rules | None = None, with_text: bool = True) -> DataFrame:
    """Counts, verdict and, ``with_text``, the ``cleaned`` text of every row of ``docs(doc_id, text)``.

    A null or empty text has no words, so it fails the base rules and cleans to an empty text. Each row is judged
    by itself: repeated rows and null ids stay, other columns are not read, an empty table gives no rows. Lines
    without a word are kept as they are and count for nothing. A word of any length is one word.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(tidy(_run(rules or Rules(), with_text)), COLUMNS + (", cleaned string" if with_text else ""))
