"""Text functions as Column -> Column: everything here stays inside Catalyst.

Java's ``\\s`` and ``\\w`` are ASCII unless ``(?U)`` is given; Python's white
space also has the controls 0x1C-0x1F, so both are named where words are cut.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x1c-\x1f"
# Java asks each part of a class in turn, so what most signs are comes first: words of visible ASCII, and signs that are none.
WORD = rf"(?U)(?>[!-~]+(?![^{SPACE}]))|[^{SPACE}]+"
SENTENCE_GAP = rf"(?sU)[[^!-~]&&[{SPACE}]](?<=[.!?…].)[{SPACE}]*+"
IMAGE_SUFFIXES = ("avif", "jpeg", "jpg", "png", "tif", "tiff", "webp")
TABULAR_FORMATS = ("csv", "tsv", "xls", "xlsx")
URL = r"https?://[^\s<>'\")\]]+"

# Function words counted by the language vote.
VOTE_WORDS = {
    "es": "el la los las de del que en para por con una un como se su sus entre sobre también desde",
    "en": "the of and to in for that with as is are from by this an on between also their its",
    "pt": "o a os as de do da que em para por com uma um como se sua suas entre sobre também dos",
}
# Signs that the weighted detector counts as patterns.
PATTERNS = {
    "es": ["ñ", "¿", "¡", "ción", "ciones", "mente", "ía", "ado", "ido", "dad", "aje"],
    "en": ["th", "ing", "tion", "ed", "ly", "ough", "wh", "'s"],
    "pt": ["ã", "õ", "ç", "ção", "ções", "lh", "nh", "eiro", "eira", "dade", "gem"],
}
# Words that set a language apart from its neighbours; a full table is a parameter, see load_markers.
DISTINCTIVE = {
    "es": "también porque mientras entonces además después aquí así puede había mismo cada y es son fue han hay más muy sin según",
    "en": "however therefore within without among whose which whether since such both every any some most many was were have has be not",
    "pt": "não também embora enquanto porém ainda depois aqui assim isto isso pode havia mesmo cada são foi tem é muito mais com",
}
WEIGHTS = {"common": 0.5, "distinctive": 2.0, "pattern": 1.5}
MOST_PER_PATTERN = 3


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once.

    Written into an expression several times, or within a lambda, a value is
    computed as often; the variable of a lambda is not.
    """
    return F.get(F.transform(F.array(value), f), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def is_blank(text: Column) -> Column:
    """Whether a text has no words; read up to the first of them.  Null has none."""
    return ~F.coalesce(text.rlike(f"(?U)[^{SPACE}]"), F.lit(False))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^[{SPACE}]+|[{SPACE}]+$", "")


def clean_text(text: Column) -> Column:
    """Newlines to \\n, tabs to spaces, other unprintable signs gone, runs of spaces and newlines bounded."""
    text = F.translate(F.regexp_replace(text, r"\r\n?", "\n"), "\t", " ")
    text = F.regexp_replace(text, r"[\p{C}\p{Z}&&[^ \n]]", "")
    text = F.regexp_replace(F.regexp_replace(text, r"(?U)[^\S\n]+", " "), " *\n *", "\n")
    return F.regexp_replace(F.regexp_replace(text, "\n{3,}", "\n\n"), r"^[ \n]+|[ \n]+$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def format_name(extension: Column) -> Column:
    bare = F.regexp_replace(F.lower(extension), r"^\.", "")
    return F.when(bare.isin("html", "htm"), "html").when(bare.isin(*IMAGE_SUFFIXES), "imagen").otherwise(bare)


def phenomenon(path: Column) -> Column:
    """1, 2 or 3 from the first path part that begins with F1_, F2_ or F3_; else null."""
    found = F.regexp_extract(F.upper(path), "(?:^|/)F([123])_", 1)
    return F.when(found != "", found.cast("int"))


def document_id(path: Column, content: Column) -> Column:
    """Content identity: path (lower case) and bytes."""
    return F.concat(F.lit("DOC-"), F.substring(F.sha2(F.concat(F.encode(F.lower(path), "UTF-8"), content), 256), 1, 12))


def fast_document_id(path: Column, size: Column, mtime_ns: Column) -> Column:
    """Identity by path, size and modification time."""
    return F.concat(F.lit("DOC-"), F.substring(F.sha2(F.concat(F.lower(path), size.cast("string"), mtime_ns.cast("string")), 256), 1, 12))


def urls(text: Column) -> Column:
    """Distinct URLs, trailing .,;) removed, sorted."""
    found = F.transform(F.regexp_extract_all(text, F.lit(URL), 0), lambda u: F.regexp_replace(u, "[.,;)]+$", ""))
    return F.array_sort(F.array_distinct(F.filter(found, lambda u: u != "")))


def is_pure_url(text: Column) -> Column:
    bare = strip(text)
    found = F.regexp_extract_all(bare, F.lit(URL), 0)
    return (F.size(found) == 1) & (F.regexp_replace(found[0], "[.,;)]+$", "") == bare)


def without_accents(text: Column) -> Column:
    """Accents of Latin letters removed; the letters this engine's languages use (fixed values)."""
    return F.translate(text, "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ", "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY")


def normalise_for_match(text: Column) -> Column:
    """Lower case, no accents, single spaces, trimmed."""
    bare = F.regexp_replace(without_accents(F.lower(text)), r"\p{Mn}+", "")
    return F.trim(F.regexp_replace(bare, f"(?U)[{SPACE}]+", " "))


def _plain(values: str) -> list[str]:
    return sorted({w.translate(str.maketrans("áéíóúüñãõç", "aeiouunaoc")) for w in values.split()})


def _hits(found: Column, values: list[str]) -> Column:
    return F.size(F.filter(found, lambda w: w.isin(*values)))


def language_vote(text: Column) -> Column:
    """es, en or pt by function words of the first 20,000 characters; 'desconocido' below 3 hits or on a tie."""
    found = F.transform(F.regexp_extract_all(F.lower(F.substring(text, 1, 20000)), F.lit("[a-záéíóúüñãõç]+"), 0), without_accents)
    es, en, pt = (_hits(found, _plain(VOTE_WORDS[k])) for k in ("es", "en", "pt"))
    top = F.greatest(es, en, pt)
    tied = (es == top).cast("int") + (en == top).cast("int") + (pt == top).cast("int") > 1
    return F.when(F.coalesce(top < 3, F.lit(True)) | tied, "desconocido").when(es == top, "es").when(en == top, "en").otherwise("pt")


def default_markers() -> dict[str, dict[str, list[str]]]:
    return {k: {"common_words": VOTE_WORDS[k].split(), "distinctive_words": DISTINCTIVE[k].split(), "patterns": PATTERNS[k]} for k in ("es", "en", "pt")}


def load_markers(path: str) -> dict[str, dict[str, list[str]]]:
    """A marker table of the same form from a JSON file."""
    with open(path, encoding="utf-8") as f:
        table = json.load(f)
    for language, kinds in table.items():
        for kind in ("common_words", "distinctive_words", "patterns"):
            if not isinstance(kinds.get(kind), list) or not all(isinstance(x, str) and x for x in kinds[kind]):
                raise ValueError(f"invalid markers for {language}.{kind}")
    return table


def sample(text: Column, size: int) -> Column:
    """The whole text up to three times ``size``; else its beginning, centre and end."""
    n = F.length(text)
    centre = F.floor((n - size) / 2).cast("int")
    if size < 3:
        parts = F.concat(F.substring(text, 1, size), text.substr(centre + 1, F.lit(size)), text.substr(n - size + 1, F.lit(size)))
    else:
        parts = F.concat_ws("\n", F.substring(text, 1, size), text.substr(centre + 1, F.lit(size)), text.substr(n - size + 3, F.lit(size)))
    return F.when(n <= 3 * size, text).otherwise(parts)


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a fixed string."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part)))) / F.lit(len(part.encode()))


def few_occurrences(text: Column, part: str, most: int) -> Column:
    """Non-overlapping occurrences of a fixed string, at most ``most``; a text is read up to the last of them only."""
    if any(part[:k] == part[-k:] for k in range(1, len(part))):  # substring_index would count overlapping ones
        n = F.least(occurrences(text, part), F.lit(float(most)))
    else:
        reaches = lambda k: F.octet_length(F.substring_index(text, part, k)) < F.octet_length(text)
        n = F.coalesce(*[F.when(reaches(k), float(k)) for k in range(most, 1, -1)], F.lit(1.0))
    # most patterns are in few texts, and looking for one is cheaper than counting it
    return F.when(F.contains(text, F.lit(part)), n).otherwise(0.0)


def language_scores(text: Column, markers: dict | None = None, size: int = 2000) -> Column:
    """struct of one score per language: weighted common words, distinctive words and patterns."""
    markers = markers or default_markers()
    marks = sorted({w for m in markers.values() for kind in ("common_words", "distinctive_words") for w in m[kind]})
    plain = F.lower(sample(text, size))
    if any(re.search(r"\s", p) for m in markers.values() for p in m["patterns"]):  # else spaces change neither words nor patterns
        plain = F.trim(F.regexp_replace(plain, f"(?U)[{SPACE}]+", " "))

    def scored(plain: Column, ascii: Column, found: Column) -> Column:
        scores = []
        for language, m in markers.items():
            few = ((p, few_occurrences(plain, p, MOST_PER_PATTERN)) for p in m["patterns"])
            pattern = sum((n if p.isascii() else F.when(ascii, 0.0).otherwise(n) for p, n in few), F.lit(0.0))
            score = _hits(found, m["common_words"]) * WEIGHTS["common"] + _hits(found, m["distinctive_words"]) * WEIGHTS["distinctive"] + pattern * WEIGHTS["pattern"]
            scores.append(F.coalesce(score.cast("double"), F.lit(0.0)).alias(language))
        return F.struct(*scores)

    # letters of ASCII come first, since most are: the classes behind them are slower
    cut = lambda t: F.regexp_extract_all(t, F.lit(r"[abcdefghijklmnopqrstuvwxyz\p{L}\p{Nl}\p{No}]+(?:['’][\p{L}\p{Nl}\p{No}]+)?"), 0)
    marked = lambda t: F.filter(cut(t), lambda w: w.isin(*marks))
    return bound(plain, lambda t: bound(F.octet_length(t) == F.length(t), lambda ascii: bound(marked(t), lambda found: scored(t, ascii, found))))


def decide_language(scores: Column, languages: tuple[str, ...] = ("es", "en", "pt"), default: str = "es", least_score: float = 3.0, least_confidence: float = 0.5, least_margin: float = 1.5) -> Column:
    """struct(language, confidence, margin, is_ambiguous) of a score struct; ties go to the earlier language."""

    def decided(scores: Column) -> Column:
        values = [scores[k] for k in languages]
        ordered = F.sort_array(F.array(*values), asc=False)
        return bound(ordered, lambda o: bound(sum(values[1:], values[0]), lambda total: judged(scores, o[0], o[1], total)))

    def judged(scores: Column, best: Column, second: Column, total: Column) -> Column:
        pick = F.lit(languages[-1])
        for k in reversed(languages[:-1]):
            pick = F.when(scores[k] == best, k).otherwise(pick)
        confidence = F.when(total > 0, best / total).otherwise(0.0)
        ambiguous = (best < least_score) | (confidence < least_confidence) | (best - second < least_margin)
        return F.struct(F.when(ambiguous, default).otherwise(pick).alias("language"), confidence.alias("confidence"), (best - second).alias("margin"), ambiguous.alias("is_ambiguous"))

    return bound(scores, decided)


def head_words(text: Column, most: int) -> Column:
    return F.array_join(F.slice(words(text), 1, most), " ")


def truncate_at_sentence(text: Column, most: int = 250, fallback: str = "cut") -> Column:
    """At most ``most`` words, cut behind the last '. ', '? ' or '! '.

    Without such a place: the cut text ('cut'), the whole text ('whole') or an
    error ('raise').
    """
    cut = head_words(text, most)
    kept = F.regexp_extract(cut, r"(?s)^(.*[.?!]) ", 1)
    other = {"cut": cut, "whole": text, "raise": F.raise_error(F.lit("no sentence end within the bound")).cast("string")}[fallback]
    return F.when(word_count(text) <= most, text).when(kept != "", strip(kept)).otherwise(other)


def has_terminal_end(text: Column) -> Column:
    return F.right(F.regexp_replace(text, f"(?U)[{SPACE}]+$", ""), F.lit(1)).isin(".", "?", "!", "…")


# Last words behind which a sentence goes on.
CONNECTORS = ("a", "al", "and", "con", "da", "das", "de", "del", "do", "dos", "e", "el", "en", "for", "in", "la", "las", "los", "o", "of", "on", "or", "para", "por", "que", "the", "to", "um", "uma", "y")

# What marks fields of structured sources and captions of page layouts.
JSON_FIELDS = r"(?:keywords\[\d+\]:|doi:|issue:|body_paragraphs\[\d+\]:|lists\[\d+\]:|alerta_meta\.)"
CAPTIONS = ("[Pagina ", "Gráfico ", "Tabla ", "Fuente:", "FUENTE:", "Figura ", "CUADRO ", "Capítulo ", "CAPÍTULO ", "Anexo ", "ANEXO ")


def is_structural_ending(fmt: Column, text: Column) -> Column:
    """Whether a text is a table, list or caption rather than prose that must end in a sentence."""
    tail = F.when(F.length(text) > 220, F.right(text, F.lit(220))).otherwise(text)
    last = F.regexp_replace(F.element_at(F.concat(F.array(F.lit("")), words(text)), -1), r"[).\]]+$", "")
    caption = sum((F.contains(tail, F.lit(c)).cast("int") for c in CAPTIONS), F.lit(0)) > 0
    telling = last.rlike(r"^\p{Nd}+$") | ((F.upper(last) == last) & (F.lower(last) != last)) | F.contains(tail, F.lit("Pagina")) | F.contains(tail, F.lit("Gráfico")) | F.contains(tail, F.lit("Tabla"))
    lists = (F.regexp_count(text, F.lit(r"(?U)(?<!\w)[a-z]\)")) >= 2) & F.contains(text, F.lit(";"))
    pdf = (F.regexp_count(text, F.lit(r"\d+[,.]\d+%")) >= 4) | lists | (caption & telling)
    low = F.lower(fmt)
    return F.when(low == "json", text.rlike(JSON_FIELDS)).when(low == "pdf", pdf).otherwise(False)


def bounded_fragment(fmt: Column, text: Column, most: int = 250) -> Column:
    """At most ``most`` words of a fragment, ending in a sentence unless it is structural; null if neither is possible."""
    cut = head_words(text, most)
    kept = strip(F.regexp_extract(cut, r"(?s)^(.*[.!?…])(?=\s|$)", 1))
    return F.when(word_count(text) <= most, text).when(has_terminal_end(cut) | is_structural_ending(fmt, text), cut).when(kept != "", kept)


def is_structural_oversize(text: Column) -> Column:
    """Code, tables, lists, queries and encoded blobs: units that may exceed the limit of prose."""
    found = words(text)
    n = F.size(found)
    bullets = F.regexp_count(text, F.lit(r"(?U)(?:^|\s)[•▪◦●]\s*"))
    blob = F.array_join(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_%!+=/-]{40,}"), 0), "")
    alpha = F.filter(found, lambda w: w.rlike(r"\p{L}"))
    bare = lambda w: F.regexp_replace(w, r"^[.,:;()\[\]]+|[.,:;()\[\]]+$", "")
    upper = F.size(F.filter(alpha, lambda w: (F.upper(bare(w)) == bare(w)) & (F.lower(bare(w)) != bare(w))))
    count = lambda p: F.regexp_count(text, F.lit(p))
    return (
        (count(r"(?iU)\b(?:SELECT|FROM|JOIN|WHERE|GROUP\s+BY|ORDER\s+BY|UNION|ON)\b") >= 4)
        | (count(r"(?iU)(?:^|\s)(?:\(?[a-zivx]+\)|\(\d+\))(?=\s|[,;:])") >= 8)
        | (bullets >= 4)
        | ((bullets >= 1) & text.rlike(r"(?i)\[Pagina\s+\d+\]") & (n >= 100))
        | (count(r"(?iU)\b(?:AND|OR|NOT)\b|\[[^\]]{1,80}\]") >= 12)
        | (count(r"(?i)(?:https?://|www\.)") >= 4)
        | ((F.length(blob) >= 400) & blob.rlike(r"\d") & blob.rlike("[_%!+=/-]"))
        | ((n >= 100) & ((occurrences(text, ",") >= 20) | (occurrences(text, ";") >= 8)))
        | ((F.size(alpha) >= 40) & (upper / F.greatest(F.size(alpha), F.lit(1)) >= 0.70))
    )


def looks_like_prose(text: Column, least: int = 8, found: Column | None = None) -> Column:
    """Enough words, most of them with letters; ``found`` are the words of ``text``, where they are at hand."""
    found = words(text) if found is None else found
    return (F.size(found) >= least) & (F.size(F.filter(found, lambda w: w.rlike(r"\p{L}"))) / F.greatest(F.size(found), F.lit(1)) >= 0.6)


def word_overlap(left: Column, right: Column, most: int = 80) -> Column:
    """Longest run of words that ends ``left`` and begins ``right``."""
    return shared_words(words(left), words(right), most)


def shared_words(left: Column, right: Column, most: int = 80) -> Column:
    """Longest run that ends the words ``left`` and begins the words ``right``."""
    few = lambda a: F.least(F.size(a), F.lit(most))

    def longest(a: Column, b: Column) -> Column:
        top = F.least(F.size(a), F.size(b))
        sizes = F.when(top > 0, F.sequence(F.lit(1), top)).otherwise(F.array().cast("array<int>"))
        # a run can only begin where the first word of the right stands: these few are compared
        begun = F.filter(sizes, lambda k: F.element_at(a, -k) == F.get(b, F.lit(0)))
        return F.coalesce(F.array_max(F.filter(begun, lambda k: F.slice(a, -k, k) == F.slice(b, F.lit(1), k))), F.lit(0))

    ends = lambda a: F.when(F.size(a) > 0, F.slice(a, -few(a), few(a))).otherwise(F.array().cast("array<string>"))
    begins = lambda b: F.slice(b, F.lit(1), few(b))
    return bound(left, lambda a: bound(right, lambda b: bound(ends(a), lambda x: bound(begins(b), lambda y: longest(x, y)))))


def unit_overlap(left: Column, right: Column) -> Column:
    """Number of units (arrays of sentences) that end ``left`` and begin ``right``."""
    top = F.least(F.size(left), F.size(right))
    sizes = F.when(top > 0, F.sequence(F.lit(1), top)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_max(F.filter(sizes, lambda k: F.slice(left, -k, k) == F.slice(right, F.lit(1), k))), F.lit(0))


def row_overlap(left: Column, right: Column, most: int = 16_384) -> Column:
    """Longest text of whole words that ends ``left`` and begins ``right``, in characters: the overlap of tables."""
    top = F.least(F.length(left), F.length(right), F.lit(most))
    begins = lambda k: (k == F.length(left)) | F.substr(left, F.length(left) - k, F.lit(1)).rlike(f"(?U)[{SPACE}]")
    ends = lambda k: (k == F.length(right)) | F.substr(right, k + 1, F.lit(1)).rlike(f"(?U)[{SPACE}]")
    same = lambda k: F.endswith(left, F.substr(right, F.lit(1), k))
    sizes = F.when(top > 0, F.sequence(F.lit(1), top)).otherwise(F.array().cast("array<int>"))
    # only ends of words can end the overlap: these few are compared
    return F.coalesce(F.array_max(F.filter(F.filter(sizes, ends), lambda k: begins(k) & same(k))), F.lit(0))


def boundary_offsets(sentences: Column) -> Column:
    """Ends of all sentences but the last in their join by one space."""
    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(-1).alias("at"))

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + 1 + F.length(x)
        return F.struct(F.array_append(s["ends"], at).alias("ends"), at.alias("at"))

    return F.aggregate(F.slice(sentences, F.lit(1), F.greatest(F.size(sentences) - 1, F.lit(0))), start, step, lambda s: s["ends"])


def excerpt(text: Column, most: int) -> Column:
    """Single-spaced beginning of a text."""
    return F.substring(F.trim(F.regexp_replace(text, f"(?U)[{SPACE}]+", " ")), 1, most)


def edges(text: Column, most: int) -> Column:
    """Single-spaced text, or its first and last ``most`` characters if it is longer than both."""
    plain = F.trim(F.regexp_replace(text, f"(?U)[{SPACE}]+", " "))
    return F.when(F.length(plain) <= 2 * most, plain).otherwise(F.concat(F.substring(plain, 1, most), F.lit(" ... "), F.right(plain, F.lit(most))))


def normalised_digest(text: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(text, f"(?U)[{SPACE}]+", " ")), 256)


def safe_log(text: Column) -> Column:
    """Control characters as spaces, for logs."""
    return F.regexp_replace(text, r"\p{Cc}", " ")


def row_units(text: Column) -> Column:
    """Non-blank lines, stripped: the units of tabular formats."""
    return F.filter(F.transform(F.split(text, r"\R|[\x1c-\x1e]"), strip), lambda u: u != "")


def sentence_units(text: Column) -> Column:
    """Sentences cut behind . ! ? or an ellipsis and white space; stripped, empty ones dropped.

    Cuts take all white space, so that only the first and the last can have more.
    """
    cut = F.split(text, SENTENCE_GAP)
    stripped = lambda parts: F.transform(parts, lambda u, i: F.when((i == 0) | (i == F.size(parts) - 1), strip(u)).otherwise(u))
    return F.filter(bound(cut, stripped), lambda u: u != "")
