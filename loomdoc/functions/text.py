"""Column functions of the text kernel (all run in the JVM)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words, list bullets, heading patterns, accents.
STOP_ES = (
    "el la los las un una unos unas de del al a y o u en con por para que se su sus es son ser como más no si sí ya lo le les "
    "esto esta estas estos ese esa eso esas esos muy pero también entre sobre sin"
).split()
STOP_EN = (
    "the a an and or of to in on for with as by is are be this that these those it its at from not yes no very "
    "but also between about without into than more most less least"
).split()
BULLETS = "•·◦▪–—*-"
HEADINGS = (
    "introducción|resumen|abstract|objetivos?",
    "síntomas?|symptoms?",
    "tratamiento|treatment|terapia",
    "discusión|discussion",
    "conclusiones?|conclusión|conclusions?",
    "complicaciones?|limitations?",
    "marco te[oó]rico|background",
    "m[eé]todos?|metodolog[ií]a|methods?",
)
ACCENTED, PLAIN = "áéíóúüñäëïöçàèìòùâêîôûãõåýÿ", "aeiouunaeiocaeiouaeiouaoayy"
SELECTOR_LETTERS = "0-9a-záéíóúüñäëïöüçàèìòùâêîôû"


#: What (?U)\s matches.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at the ends, Unicode's included."""
    return F.trim(c, F.lit(SPACES))


def filled(c: Column) -> Column:
    """Whether there is more than white space."""
    return c.rlike(r"(?U)\S")


def collapsed(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def normalized_text(c: Column) -> Column:
    """NBSP to space, no CR, words joined over '-\\n', white space collapsed."""
    c = F.replace(F.replace(c, F.lit(" "), F.lit(" ")), F.lit("\r"), F.lit(""))
    return collapsed(F.replace(c, F.lit("-\n"), F.lit("")))


def normalized_line(c: Column) -> Column:
    return collapsed(F.replace(F.replace(c, F.lit(" "), F.lit(" ")), F.lit("\r"), F.lit("")))


def is_list_item(c: Column) -> Column:
    return F.coalesce(c.rlike(rf"(?U)^\s*[{BULLETS}]"), F.lit(False))


def list_item_text(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"(?U)^\s*[{BULLETS}]\s*", ""))


def looks_like_heading(c: Column) -> Column:
    """At most 80 characters, no '.', ':' or ';' at the end, half of the letters upper-case."""
    letters, upper = F.length(F.regexp_replace(c, r"[^\p{L}]", "")), F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))
    return (F.length(c) <= 80) & ~c.rlike(r"[.:;]$") & (letters > 0) & (2 * upper >= letters)


def is_section_heading(c: Column) -> Column:
    """At most 180 characters, and a known heading word or a bullet first."""
    line = strip(c)
    words = "|".join(f"(?:{x})" for x in HEADINGS)
    may_be = c.rlike(rf"(?iuU)^\s*(?:(?:{words})\b|[-•*]\s)")  # few texts begin so; only they are looked at whole
    return may_be & (F.length(line) <= 180) & (line.rlike(rf"(?iuU)^\s*(?:{words})\b.*$") & ~line.contains("\n") | line.rlike(r"(?U)^\s*[-•*]\s+\S+"))


#: Frequent words of the languages told apart; of equal votes the first language has it.
VOTES = {
    "es": "el la los las de que y en un una por con para no se del al es lo como más su pero".split(),
    "en": "the of and to in a is that it for was on are as with his they at be this from have or".split(),
    "pt": "o a os as de que e em um uma por com para não se do da dos das é como mais seu mas".split(),
    "fr": "le la les de des et en un une que qui dans pour pas sur par est au avec ce il sont du".split(),
    "de": "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
}


def detected_language(c: Column) -> Column:
    """Language of a text by its frequent words; und without any."""
    letters = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), F.lit(0))
    among = lambda words: F.size(F.filter(letters, lambda w: w.isin(words)))
    votes = [F.struct((-among(words)).alias("v"), F.lit(i).alias("i"), F.lit(k).alias("lang")) for i, (k, words) in enumerate(VOTES.items())]
    best = F.array_min(F.array(*votes))
    return F.when(best["v"] < 0, best["lang"]).otherwise("und")


def block_type(c: Column) -> Column:
    return F.when(is_list_item(c), "list_item").when(looks_like_heading(c), "heading").otherwise("paragraph")


def sentences(c: Column) -> Column:
    parts = F.transform(F.split(c, r"(?U)(?<=[.?!])\s+|\n{2,}"), strip)
    return F.filter(parts, lambda x: x != "")


WORD_LETTERS = "0-9a-záéíóúüñ"


def _each(letters: str) -> str:
    """A class of letters with its ranges written out: single ones are one table look-up in Java, ranges a chain of calls."""
    return re.sub("(.)-(.)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), letters)


def _any_of(listed: list[str]) -> str:
    """Alternatives by their first letter."""
    starts = dict.fromkeys(w[0] for w in listed)
    return "|".join(f"{x}(?:{'|'.join(w[1:] for w in listed if w[0] == x)})" for x in starts)


def _runs(c: Column, letters: str, but: list[str] | None = None) -> Column:
    """Runs of letters in lower-cased text, without those in but; one regular expression, no lambda over tokens."""
    letters = _each(letters)
    skip = f"(?<![{letters}])(?!(?:{_any_of(but)})(?![{letters}]))" if but else ""
    return F.regexp_extract_all(F.lower(c), F.lit(f"{skip}[{letters}]++"), F.lit(0))


def words(c: Column) -> Column:
    """Lower-cased tokens of digits and letters with Spanish accents, stop words included."""
    return _runs(c, WORD_LETTERS)


def tokens(c: Column, lang: Column) -> Column:
    """words() without the stop words of English (lang en...) or Spanish (any other)."""
    return F.when(F.lower(lang).startswith("en"), _runs(c, WORD_LETTERS, STOP_EN)).otherwise(_runs(c, WORD_LETTERS, STOP_ES))


def selector_tokens(c: Column) -> Column:
    return _runs(c, SELECTOR_LETTERS)


def selector_token_count(c: Column) -> Column:
    """Number of selector_tokens()."""
    return F.regexp_count(F.lower(c), F.lit(f"[{_each(SELECTOR_LETTERS)}]++"))


def rough_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"[{_each('A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9')}]{{2,}}"), F.lit(0))


def space_tokens(c: Column, min_len: int = 3) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(rf"(?U)\S{{{min_len},}}"), F.lit(0))


def folded(c: Column) -> Column:
    """Lower case, accents off, letters and single spaces only."""
    plain = F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), r"[^\x00-\x7F]", "")
    return collapsed(F.regexp_replace(plain, r"(?U)[^a-z\s]", " "))


def keyword(c: Column) -> Column:
    return F.lower(strip(c))


def topic_text(c: Column) -> Column:
    """Soft hyphens, white space, a leading bullet or number, and quotes made uniform."""
    t = collapsed(F.replace(c, F.lit("­"), F.lit("-")))
    t = F.regexp_replace(t, r"(?U)^(?:[-•*]\s+|\d+[.)]\s+)", "")
    return F.regexp_replace(F.regexp_replace(t, "[“”«»]", '"'), "[‘’]", "'")


def unique_sorted(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(c, lambda x: x != ""), keyword)))


def estimated_tokens(n_chars: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n_chars / 4).cast("int"))


def short_hash(c: Column) -> Column:
    return F.upper(F.substring(F.sha1(c), 1, 10))


def chunk_id(doc_id: Column, order: Column, text: Column) -> Column:
    return F.concat(F.substring(doc_id.cast("string"), 1, 8), F.lit("_"), F.lpad(order.cast("string"), 4, "0"), F.lit("_"), short_hash(text))


def legacy_chunk_id(doc_id: Column, start: Column, end: Column, strategy: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", doc_id, start, end, strategy)), 1, 16)


def document_id(path: Column) -> Column:
    return F.concat(F.lit("DOC-"), F.upper(F.left(F.sha2(path, 256), F.lit(12))))


def mime_type(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    known = {".pdf": "application/pdf", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".doc": "application/msword", ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".tif": "image/tiff", ".tiff": "image/tiff", ".csv": "text/csv", ".txt": "text/plain", ".json": "application/json", ".html": "text/html"}
    out = F.lit("application/octet-stream")
    for k, v in known.items():
        out = F.when(ext == k, v).otherwise(out)
    return out


def docx_heading_level(style: Column) -> Column:
    """Null unless the style is a heading; the first of 1 to 6 that its name holds, else 1."""
    level = F.lit(1)
    for n in range(6, 0, -1):
        level = F.when(style.contains(str(n)), n).otherwise(level)
    return F.when(F.lower(style).contains("heading"), level)


def shorten(c: Column, width: int, mark: str = "...") -> Column:
    return F.when(F.length(c) > width, F.concat(F.left(c, F.lit(width - len(mark))), F.lit(mark))).otherwise(c)


def type_token_ratio(toks: Column) -> Column:
    return F.when(F.size(toks) > 0, F.size(F.array_distinct(toks)) / F.size(toks)).otherwise(0.0)


def jaccard(a: Column, b: Column, both_empty: float = 1.0) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, both_empty).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 with a zero vector."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def unit(a: Column) -> Column:
    """Of length 1; a zero vector as it is.  The length is a lambda's argument, so that it is taken once, not once an element."""
    scaled = lambda n: F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))
    return F.get(F.transform(F.array(norm(a)), scaled), F.lit(0))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def bucket(token: Column, size: int = 4096) -> Column:
    """Place of a token in a hashed bag of words."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % size).cast("int")
