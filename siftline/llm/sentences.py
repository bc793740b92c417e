"""Problem 10: sentence units by cascading tables of break and no-break rules.

A rule is a pair of patterns, one for the text that ends with the mark and one for the text after it, and a
verdict. Tables are tried in order: the one of the document's language, the common one, then those of
the other languages (documents mix languages); within a table the first rule that matches decides. A
position that no rule matches is a break, because the last rule of the cascade says so.

Candidates are runs of closing marks with any emoji after them. Line breaks and the end of the text
always end a unit; so does, in Thai, a blank between two Thai letters. Marks inside a quotation that is
closed on its line are no candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ".!?…。！？؟"
LINE_BREAK = regex.compile(r"[\n\r\x0b\x0c\x85  ]+")
CANDIDATE = regex.compile(rf"[{MARKS}]+(?:[^\S\n\r\x0b\x0c\x85  ]*[\p{{Extended_Pictographic}}\U0001F1E6-\U0001F1FF][\p{{Extended_Pictographic}}\U0001F1E6-\U0001F1FF\U0001F3FB-\U0001F3FF️‍]*)*|(?<=[\p{{L}}\p{{M}}])(?<=\p{{Thai}})[  　\t]+(?=\p{{Thai}})(?=[\p{{L}}\p{{M}}])")
QUOTES = regex.compile('["“”„«»‹›「」『』]')
CLOSES = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹", "「": "」", "『": "』"}
ADDRESS = regex.compile(r"(?i:://|www\.|@)\S*")
WINDOW = 48  # characters that a rule may look at on either side; addresses are followed over any length

# Abbreviations that never end a unit, by language, in any case (the mark is not part of them).
ABBREVIATIONS = {
    "en": "Mr Mrs Ms Dr Prof St Jr Sr vs approx incl excl Inc Ltd Co Corp dept ext Ave Blvd Rd Capt Sgt cf",
    "de": "Dr Prof Hr Fr vgl ca inkl exkl zzgl bzw bspw evtl ggf sog geb gest Mio Mrd Str allg insb",
    "fr": "MM Mme Mlle Dr env bd av boul tél Ste St chap",
    "es": "Sr Sra Srta Dr Dra Dña Ud Uds aprox Avda Av Ltda",
    "pt": "Sr Sra Srta Dr Dra Prof Profa Av aprox Ltda Exmo Ilmo",
    "it": "sig sigg dott prof avv ing ca geom rag",
    "ru": "ул стр ок руб коп проф тыс млн млрд акад просп см напр",
    "ar": "أ.د",
    "ja": "Inc Ltd Co", "zh": "Inc Ltd Co", "ko": "Inc Ltd Co", "th": "ดร พ.ศ ค.ศ น.ส",
}
# Abbreviations that do not end a unit when a number follows.
BEFORE_NUMBERS = "No Nos Nr núm num pág págs pag pagg fig Abb vol art tab стр рис табл гл Bd Kap cap sec ver tel тел"
# Month names after an ordinal number with a point.
MONTHS = "Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember"

Rule = tuple[regex.Pattern, regex.Pattern, bool]


def _rule(before: str, after: str, ends: bool) -> Rule:
    return regex.compile(f"(?i:{before})$"), regex.compile(after), ends


def _any(words: str) -> str:
    return "|".join(map(regex.escape, words.split()))


@lru_cache(1)
def tables() -> dict[str, list[Rule]]:
    """The rule tables; "common" and "last" frame those of the languages."""
    apart = r"(?<![\p{L}\p{M}\p{N}])"
    dots = r"(?:\.{2,}|[.]*…[.…]*)"
    found = {lang: [_rule(rf"{apart}(?:{_any(words)})\.", "", False)] for lang, words in ABBREVIATIONS.items()}
    found["de"] += [_rule(r"\p{L}str\.", r"\s*\d", False), _rule(rf"{apart}\d{{1,2}}\.", rf"\s+(?i:{_any(MONTHS)})", False)]
    found["common"] = [
        _rule(rf"[{MARKS}]*[!?。！？؟][{MARKS}]*", "", True),  # marks that are never part of a word
        _rule(dots, r"[\s\p{Extended_Pictographic}\uFE0F\u200D]*[\"“„«»‹「『‘'(\[]*\s*[¿¡]*\p{Lu}", True),  # an ellipsis before an upper-case letter
        _rule(dots, "", False),
        _rule(r"\p{N}\.", r"\p{N}", False),  # numbers, versions, dates
        _rule(r"(?:://|www\.|@)\S*\.", r"\w", False),  # addresses
        _rule(r"\w\.", r"(?:com|org|net|edu|gov|info|example|html?|php|pdf|jpg|png)\b", False),
        _rule(rf"{apart}\p{{L}}\p{{M}}*\.", r"", False),  # initials and one-letter abbreviations
        _rule(rf"{apart}\p{{L}}{{1,3}}\.", r"\p{Ll}{1,3}(?!\p{L})", False),  # sig.ra
        _rule(rf"{apart}(?:{_any(BEFORE_NUMBERS)})\.", r"\s*\d", False),
    ]
    found["last"] = [_rule("", "", True)]
    return found


@lru_cache(64)
def cascade(lang: str) -> tuple[Rule, ...]:
    t = tables()
    order = [lang] if lang in ABBREVIATIONS else []
    order += ["common"] + [x for x in ABBREVIATIONS if x != lang] + ["last"]
    return tuple(r for name in order for r in t[name])


def quoted(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """Spans of text[begin:end], a line, that lie in a quotation closed on the line."""
    spans: list[tuple[int, int]] = []
    opened, at = "", 0
    for m in QUOTES.finditer(text, begin, end):
        c = m.group()
        if opened and c in CLOSES[opened]:
            spans.append((at, m.start()))
            opened = ""
        elif not opened and c in CLOSES:
            opened, at = c, m.end()
    return spans


def units(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """Code-point offsets of the sentence units of a text, without surrounding white space."""
    if not text:
        return []
    rules = cascade((lang or "").strip()[:2].lower())
    out: list[tuple[int, int]] = []

    def emit(lo: int, hi: int) -> None:
        while lo < hi and text[lo].isspace():
            lo += 1
        while hi > lo and text[hi - 1].isspace():
            hi -= 1
        if lo < hi:
            out.append((lo, hi))

    line = 0
    n = len(text)
    while line < n:
        brk = LINE_BREAK.search(text, line)
        stop = brk.start() if brk else n
        spans = quoted(text, line, stop)
        addresses = [m.span() for m in ADDRESS.finditer(text, line, stop)]
        start, s, link = line, 0, 0
        for m in CANDIDATE.finditer(text, line, stop):
            at = m.start()
            if m.group()[0] not in MARKS:
                emit(start, at)
                start = m.end()
                continue
            while s < len(spans) and spans[s][1] <= at:
                s += 1
            if s < len(spans) and spans[s][0] <= at:
                continue
            mark = at
            while mark < m.end() and text[mark] in MARKS:
                mark += 1
            while link < len(addresses) and addresses[link][1] <= at:
                link += 1
            inside = link < len(addresses) and addresses[link][0] < at
            if inside and text[at:mark] == "." and mark < stop and (text[mark].isalnum() or text[mark] == "_"):
                continue
            before, after = text[max(line, mark - WINDOW) : mark], text[mark : min(stop, mark + WINDOW)]
            for b, a, ends in rules:
                if a.match(after) and b.search(before):
                    if ends:
                        emit(start, m.end())
                        start = m.end()
                    break
        emit(start, stop)
        line = brk.end() if brk else n
    return out


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ids, lo, hi = [], [], []
        for doc, text, lang in zip(b["doc_id"], b["text"], b["lang"], strict=True):
            for x, y in units(text, lang):
                ids.append(doc)
                lo.append(x)
                hi.append(y)
            if len(ids) > 100_000:
                yield pd.DataFrame({"doc_id": ids, "sent_start": lo, "sent_end": hi})
                ids, lo, hi = [], [], []
        yield pd.DataFrame({"doc_id": ids, "sent_start": lo, "sent_end": hi})


def sentence_units(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(doc_id, sent_start, sent_end): every sentence unit, in one pass without a shuffle.

    Null, empty and blank texts have no unit; repeated rows come out repeatedly; a null or unknown
    language only changes the order of the tables; other columns are ignored, whatever their names.
    """
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), lang.alias("lang")).where("doc_id is not null and text is not null")
    return rows.mapInPandas(_split, "doc_id bigint, sent_start bigint, sent_end bigint")
