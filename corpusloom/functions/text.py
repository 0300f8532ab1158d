"""Text functions as Spark columns.

Java's ``\\w``, ``\\d`` and ``\\b`` are ASCII unless told otherwise, so every pattern here goes through :func:`rx`.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def rx(pattern: str, flags: str = "") -> str:
    """A pattern with Unicode character classes."""
    return f"(?{flags}U){pattern}"


def _plain_letters() -> tuple[str, str]:
    """Every letter below U+0250 that is one base letter with marks, and that letter."""
    marked, plain = [], []
    for point in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFD", chr(point))
        if len(parts) > 1 and all(unicodedata.category(c) == "Mn" for c in parts[1:]):
            marked.append(chr(point))
            plain.append(parts[0])
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _plain_letters()


def let(value: Column, use) -> Column:
    """Bind a value once inside a higher-order expression."""
    return F.transform(F.array(value), use)[0]


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _MARKED, _PLAIN), r"\p{Mn}+", "")


def strip_tokens(c: Column) -> Column:
    return F.regexp_replace(c, "‹[^›]*›", "")


def norm(c: Column) -> Column:
    """Comparable text: no style tokens, asterisks or accents, single spaces, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip_accents(F.regexp_replace(strip_tokens(c), r"\*", "")), rx(r"\s+"), " "), "^ | $", ""))


def norm_sense(c: Column) -> Column:
    """As :func:`norm`, but white space stays as it is."""
    return F.lower(strip_accents(F.regexp_replace(strip_tokens(c), r"\*", "")))


def grams(c: Column, n: int) -> Column:
    """Distinct runs of ``n`` characters, from one pass over the characters; none of a shorter text."""
    joined = lambda chars: F.transform(chars, lambda x, i: F.concat(x, *[F.get(chars, i + k) for k in range(1, n)]))
    return F.array_distinct(F.array_compact(let(F.split(c, "", -1), joined)))


def running_sums(lengths: Column) -> Column:
    """For each element of an array of whole numbers the sum of all before it.

    Sums of blocks of about the square root of the number of elements come first, so an element adds two short slices.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def over(d: Column) -> Column:
        def by(step: Column) -> Column:
            count = F.ceil(F.size(d) / step).cast("int")
            sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: total(F.slice(d, b * step + 1, step)))
            before = lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b)))
            return let(sums, lambda s: let(before(s), lambda base: F.transform(d, lambda _, k: base[F.floor(k / step).cast("int")] + total(F.slice(d, (k - k % step) + 1, k % step)))))

        return let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(d))).cast("int")), by)

    return F.when(F.size(lengths) > 0, let(lengths, over)).otherwise(F.array().cast("array<bigint>"))


def find_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def count_matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


# five number functions that differ on purpose


def _no_thousands(c: Column) -> Column:
    """Commas between digits go, left to right: ``1,2,3`` becomes ``12,3``."""
    return F.regexp_replace(c, rx(r"(\d),(\d)"), "$1$2")


def digits_sorted(c: Column) -> Column:
    """Runs of digits after thousands separators go, as sorted strings."""
    return F.array_sort(find_all(_no_thousands(c), rx(r"\d+")))


def digits_sorted_any(c: Column) -> Column:
    """As :func:`digits_sorted`, of any value as text; null reads as the word None, which has no digits."""
    return digits_sorted(F.coalesce(c.cast("string"), F.lit("None")))


def dice_and_digits(c: Column) -> Column:
    """Dice such as 2d6 and other runs of digits, sorted; separators stay."""
    return F.array_sort(find_all(c, rx(r"\d+d\d+|\d+")))


def decimals_sorted(c: Column) -> Column:
    """Numbers with at most one decimal part outside style tokens, sorted: ``2,500`` differs from ``2500``."""
    return F.array_sort(find_all(strip_tokens(c), rx(r"\d+(?:[.,]\d+)?")))


def dice_and_numbers(c: Column) -> Column:
    """A sorted bag of dice and numbers after the repair of misread dice (``ld4``, ``d4``) and without commas."""
    t = F.regexp_replace(c, "[’']", "")
    t = F.regexp_replace(t, rx(r"\b[lI](d\d)"), "1$1")
    t = F.regexp_replace(t, rx(r"\bd(\d+)\b"), "1d$1")
    dice = rx(r"\d+d\d+")
    return F.array_sort(F.concat(find_all(t, dice), find_all(F.regexp_replace(F.regexp_replace(t, dice, " "), ",", ""), rx(r"\d[\d,]*"))))


def words(c: Column) -> Column:
    return F.size(find_all(c, rx(r"\S+")))


def alternatives(found) -> str:
    return "|".join(found)


def stopwords_found(c: Column, found, flags: str = "i") -> Column:
    """Occurrences of whole words of a list."""
    return find_all(c, rx(rf"\b({alternatives(found)})\b", flags))


def letters(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z]", "")


# style markup: * ** *** and ‹tokens›


def _marks(c: Column) -> Column:
    """(bold, italic) that are open at the end, as a small state machine over runs of asterisks."""
    runs = find_all(c, r"\*{1,3}")
    start = F.struct(F.lit(False).alias("bold"), F.lit(False).alias("italic"))
    flip = lambda s, r: F.struct((s.getField("bold") != (F.length(r) >= 2)).alias("bold"), (s.getField("italic") != (F.length(r) != 2)).alias("italic"))
    return F.aggregate(runs, start, flip)


def balanced(c: Column) -> Column:
    """Whether all bold and italic that is opened is closed; three asterisks toggle both."""
    return let(_marks(c), lambda s: ~s.getField("bold") & ~s.getField("italic"))


def tokens_balanced(c: Column) -> Column:
    """Whether as many style tokens open as close."""
    return count_matches(c, "‹(?!/)") == count_matches(c, "‹/")


def close_markup(c: Column) -> Column:
    """Close what is open at the end; trailing white space goes first. Balanced texts stay as they are."""
    tail = let(_marks(c), lambda s: F.when(s.getField("bold") & s.getField("italic"), "***").when(s.getField("bold"), "**").when(s.getField("italic"), "*"))
    return F.coalesce(F.concat(F.regexp_replace(c, rx(r"\s+$"), ""), tail), c)


def align_run_in(source: Column, target: Column) -> Column:
    """Give the target's bold lead-in the source's opening and closing marks."""
    part = lambda c, i: F.regexp_extract(c, fixed.RUN_IN, i)
    both = source.rlike(fixed.RUN_IN) & target.rlike(fixed.RUN_IN) & ((part(source, 1) != part(target, 1)) | (part(source, 3) != part(target, 3)))
    rest = F.substring(target, F.length(part(target, 0)) + 1, F.length(target))
    return F.when(F.coalesce(both, F.lit(False)), F.concat(part(source, 1), part(target, 2), part(source, 3), rest)).otherwise(target)


def repair_markup(source: Column, target: Column) -> Column:
    """The target with its marks aligned and closed if that balances it, else null; balanced targets stay."""
    fixed_text = close_markup(align_run_in(F.coalesce(source, F.lit("")), target))
    return F.when(balanced(target), target).otherwise(let(fixed_text, lambda t: F.when(balanced(t) & (t != target), t)))


def strip_markup(c: Column) -> Column:
    """Without asterisks and small-caps tokens; white space stays."""
    return F.regexp_replace(c, r"\*\*|\*|‹sc›|‹/sc›", "")


def strip_markup_line(c: Column) -> Column:
    """As one line: also forced breaks become spaces, and white space is single."""
    t = F.regexp_replace(F.regexp_replace(c, r"‹sc›|‹/sc›|\*", ""), "⏎", " ")
    return F.trim(F.regexp_replace(t, rx(r"\s+"), " "))


def thousands(c: Column) -> Column:
    """``1.900`` becomes ``1,900``."""
    return F.regexp_replace(c, rx(r"(\d)\.(\d{3})\b"), "$1,$2")


def join_broken(c: Column) -> Column:
    """Paragraph breaks in the middle of a sentence become a space."""
    return F.regexp_replace(c, r"(?<=[a-záéíóúñ,;])\n\n(?=[a-záéíóúñ])", " ")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")


def title_case(c: Column) -> Column:
    """Each run of letters begins with a capital, the rest is small: ``o'neil 2nd`` becomes ``O'Neil 2Nd``."""
    return F.array_join(F.transform(find_all(c, r"\p{L}+|\P{L}+"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**31 - 1)))), "")


def comparable_token(c: Column) -> Column:
    """A word without style tokens, asterisks and outer punctuation, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip_tokens(c), r"\*", ""), "^[ .,;:]+|[ .,;:]+$", ""))


def is_legal_request(c: Column) -> Column:
    return c.rlike(rx(fixed.LEGAL_REQUEST, "i"))


def is_legal_sweep(c: Column) -> Column:
    return c.rlike(rx(fixed.LEGAL_SWEEP, "i"))


def is_numeric_cell(c: Column) -> Column:
    return c.rlike(rx(fixed.NUMERIC_CELL)) | c.rlike(rx(fixed.ORDINAL_CELL))


def ocr_noise(c: Column) -> Column:
    return count_matches(c, rx(fixed.OCR_NOISE))


def normal_tokens(c: Column) -> Column:
    """Style tokens with their own delimiters again, whatever brackets they came back with; colours in lower case."""
    colour = rx(fixed.TOKEN_COLOUR)

    def lowered(t: Column) -> Column:
        found = F.struct(F.split(t, colour, -1).alias("pieces"), find_all(t, colour, 1).alias("colours"))
        joined = lambda f: F.array_join(F.transform(f.getField("pieces"), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("‹c:"), F.lower(F.get(f.getField("colours"), i - 1)), F.lit("›"), p))), "")
        return F.when(t.rlike(colour), let(found, joined)).otherwise(t)

    plain = F.regexp_replace(c, rx(fixed.TOKEN_PLAIN), "‹$1$2›")
    return F.regexp_replace(let(plain, lowered), rx(fixed.TOKEN_COLOUR_END), "‹/c›")


def repair_extraction(c: Column) -> Column:
    """Private-use digits become digits, and the space that extraction puts after a ligature goes."""
    for glyph, digits in fixed.PRIVATE_DIGITS.items():
        c = F.replace(c, F.lit(glyph), F.lit(digits))
    return F.regexp_replace(c, rx(fixed.LIGATURE), "$1")


def small_caps_heading(source: Column, target: Column) -> Column:
    """A heading in small capitals keeps them: the target is rebuilt from the source's tokens."""
    whole = rx(fixed.SMALL_CAPS_HEADING, "s")
    inner = F.regexp_extract(source, whole, 1)
    clean = F.trim(F.regexp_replace(normal_tokens(target), "‹/?sc›|‹[^›]{0,10}›|[«»]", ""))
    raised = let(clean, lambda t: F.when(t.rlike(r"^\p{Ll}") & inner.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, F.length(t)))).otherwise(t))
    return F.when(source.rlike(whole), let(raised, lambda t: F.when(t != "", F.concat(F.lit("‹sc›"), t, F.lit("‹/sc›"))).otherwise(target))).otherwise(target)


def small_caps_run_in(source: Column, target: Column) -> Column:
    """Wrap as many words at the target's start as the source has there in small capitals, connectors not counted."""
    lead = rx(fixed.SMALL_CAPS_LEAD, "s")
    wanted = words(strip_tokens(F.regexp_extract(source, lead, 1)))
    tokens = find_all(target, rx(r"\S+"))
    plain = F.transform(tokens, lambda w: F.lower(F.regexp_replace(w, "^[.,:;»«]+|[.,:;»«]+$", "")))
    connector = lambda w: w.isin(*fixed.CONNECTORS)
    # the first word that is no connector once enough others have gone before it
    start = F.struct(F.lit(0).alias("full"), F.lit(0).alias("at"), F.lit(-1).alias("cut"))

    def step(s, w):
        stop = (s.getField("cut") < 0) & (s.getField("full") >= wanted) & ~connector(w)
        return F.struct((s.getField("full") + F.when(connector(w), 0).otherwise(1)).alias("full"), (s.getField("at") + 1).alias("at"), F.when(stop, s.getField("at")).otherwise(s.getField("cut")).alias("cut"))

    cut = F.aggregate(plain, start, step, lambda s: s.getField("cut"))
    wrapped = let(cut, lambda k: F.when(k > 0, F.concat(F.lit("‹sc›"), F.array_join(F.slice(tokens, F.lit(1), k), " "), F.lit("‹/sc› "), F.array_join(F.slice(tokens, k + 1, F.size(tokens)), " "))))
    return F.when(source.rlike(lead) & ~target.contains("‹sc›"), F.coalesce(wrapped, target)).otherwise(target)


def small_caps_kept(source: Column, target: Column) -> Column:
    return ~source.contains("‹sc›") | target.contains("‹sc›")


def unwrap_answer(c: Column) -> Column:
    """The text inside an answer that came as a serialised dictionary: its one value, or its longest string."""
    t = F.trim(c)
    single = rx(fixed.SINGLE_ANSWER, "s")
    inside = find_all(t, "['\"]([^'\"]{15,})['\"]", 1)
    longest = F.array_max(F.transform(inside, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("first"), x.alias("x")))).getField("x")
    return F.when(t.rlike(single), F.trim(F.regexp_extract(t, single, 1))).when(t.startswith("{") & t.endswith("}") & (F.length(t) > 20), F.coalesce(F.trim(longest), t)).otherwise(t)


def _letters_only(c: Column) -> Column:
    """Runs of letters in lower case. Style tokens give the same runs whatever their brackets, so they stay as they are."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-záéíóúñüA-ZÁÉÍÓÚÑÜ]+", " "))


def same_as_source(source: Column, target: Column) -> Column:
    """Whether a translation is its source again, by letters."""
    return _letters_only(source) == _letters_only(target)


def keep_capitals(source: Column, target: Column) -> Column:
    """Targets of sources in capitals (three letters or more) become capitals, unless they hold style tokens."""
    only = F.regexp_replace(source, "[^A-Za-zÁÉÍÓÚÑÜáéíóúñü]", "")
    capitals = (F.length(only) >= 3) & (F.upper(only) == only) & ~target.contains("‹")
    return F.when(capitals, F.upper(target)).otherwise(target)


def break_lists(c: Column) -> Column:
    """Check-box lists and label-value sheets get one entry per paragraph."""
    boxes = F.regexp_replace(c, rx(r"\s*\[\s*\]\s*"), " [ ] ")
    boxes = F.regexp_replace(boxes, rx(r"\s*\[ \]\s+(?=[A-ZÁÉÍÓÚÑ¿«])"), "\n\n[ ] ")
    boxes = F.regexp_replace(boxes, rx(r"\s*\[ \]\s*$"), "")
    t = F.when(count_matches(c, r"\[") >= 3, boxes).otherwise(c)
    label = rx(r"\*\*[^*]{3,30}\*\*\s*[\d+]")
    sheet = ~t.contains("|") & (count_matches(t, label) >= 2)
    return F.when(sheet, F.regexp_replace(t, rx(r"\s+(?=\*\*[^*]{3,30}\*\*\s*[\d+])"), "\n\n")).otherwise(t)


def is_definition_list(c: Column) -> Column:
    return count_matches(c, fixed.DEFINITION_ENTRY) >= 3


def glossary_root(c: Column) -> Column:
    """What of a target term must occur: without brackets and article; the last word, cut by a final vowel or s."""
    t = F.lower(F.regexp_replace(F.trim(F.split(c, r"\(")[0]), rx(r"^(el|la|los|las)\s+", "i"), ""))
    last = F.element_at(find_all(t, rx(r"\S+")), -1)
    return F.when((F.length(last) > 6) & last.rlike("[aeoáéís]$"), F.substring(last, 1, F.length(last) - 1)).otherwise(last)


def longest_alternative(c: Column) -> Column:
    """The longest part of a term between slashes and brackets, the first of equals, without an article."""
    parts = F.split(c, rx(r"\s*/\s*|\s*\(\s*"), -1)
    best = F.array_max(F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("first"), p.alias("p")))).getField("p")
    return F.regexp_replace(F.regexp_replace(best, "^[ )]+|[ )]+$", ""), rx(r"^(el|la|los|las|un|una)\s+", "i"), "")


def term_variants(c: Column) -> Column:
    """A term in lower case and cut by one and two characters, those of four characters or more; else itself."""
    t = F.lower(c)
    kept = F.filter(F.array(t, F.substring(t, F.lit(1), F.length(t) - 1), F.substring(t, F.lit(1), F.length(t) - 2)), lambda v: F.length(v) >= 4)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(t))


def term_core(c: Column) -> Column:
    """The shortest of a term's variants: it begins all others, so a text that holds any of them holds it."""
    return let(F.lower(c), lambda t: F.substring(t, F.lit(1), F.when(F.length(t) >= 6, F.length(t) - 2).when(F.length(t) == 5, F.lit(4)).otherwise(F.length(t))))


def search_key(c: Column) -> Column:
    """The first six letters of a term's last word, in lower case."""
    return F.substring(F.element_at(find_all(F.lower(c), rx(r"\S+")), -1), F.lit(1), F.lit(6))


def overflow_ids(line: Column) -> Column:
    """Blocks that a line of page checks names as too long."""
    return find_all(F.regexp_extract(line, rx(fixed.OVERFLOW_LIST), 1), rx(fixed.OVERFLOW_BLOCK), 1)


def glossary_misses(line: Column) -> Column:
    """Structs term, target of the missing glossary terms that a line of page checks names."""
    pattern = rx(fixed.GLOSSARY_MISS)
    return let(find_all(line, pattern, 2), lambda targets: F.transform(find_all(line, pattern, 1), lambda t, i: F.struct(t.alias("term"), targets[i].alias("target"))))


def name_prefixes(c: Column) -> Column:
    """First four letters of capitalised words, in lower case, once each."""
    found = F.transform(find_all(c, rx(r"\b[A-Z][a-záéíóúñ]{3,}")), lambda w: F.lower(F.substring(w, 1, 4)))
    return F.array_distinct(found)


def context_snippets(c: Column, pattern: str, around: int = 35) -> Column:
    """Each match with up to ``around`` characters on either side, line breaks as spaces.

    Matches lie between the pieces that splitting leaves, so a match begins after all pieces and matches before it.
    """

    def located(f: Column) -> Column:
        gaps, found = f.getField("gaps"), f.getField("found")
        steps = F.transform(found, lambda m, i: F.length(gaps[i]) + F.length(m))

        def cut(before: Column) -> Column:
            start = lambda i: (before[i] + F.length(gaps[i])).cast("int")
            spans = F.transform(found, lambda m, i: F.struct(F.greatest(F.lit(0), start(i) - around).alias("at"), (start(i) + F.length(m) + around).alias("end")))
            return F.transform(spans, lambda s: F.regexp_replace(F.substring(c, s.getField("at") + 1, s.getField("end") - s.getField("at")), "\n", " "))

        return let(running_sums(steps), cut)

    found = F.struct(F.split(c, pattern, -1).alias("gaps"), find_all(c, pattern).alias("found"))
    return F.when(c.rlike(pattern), let(found, located)).otherwise(F.array().cast("array<string>"))


def restore_chapter(source: Column, target: Column) -> Column:
    """A footer that lost its chapter number gets it back, before what stood after its last bar."""
    number = F.regexp_extract(source, rx(r"CHAPTER\s+(\d+)", "i"), 1)
    rest = F.trim(F.element_at(F.split(target, r"\|", -1), -1))
    rebuilt = F.when(target.contains("|"), F.concat(F.lit("Capítulo "), number, F.lit(" | "), rest)).otherwise(F.concat(F.lit("Capítulo "), number))
    return F.when((number != "") & ~target.contains(number), rebuilt).otherwise(target)


def drop_cap(c: Column, width: int = 20) -> Column:
    """(letter, text): the first letter, and the rest with about ``width`` characters of whole words in small capitals."""
    rest = F.split(F.substring(c, 2, 2**31 - 1), " ", -1)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(False).alias("over"))

    def step(s, w):
        over = s.getField("over") | (s.getField("n") >= width) | w.startswith("*") | w.startswith("«")
        return F.struct(F.when(over, s.getField("n")).otherwise(s.getField("n") + F.length(w) + 1).alias("n"), F.when(over, s.getField("k")).otherwise(s.getField("k") + 1).alias("k"), over.alias("over"))

    k = F.aggregate(rest, start, step, lambda s: s.getField("k"))
    text = let(k, lambda n: F.trim(F.concat(F.lit("‹sc›"), F.array_join(F.slice(rest, F.lit(1), n), " "), F.lit("‹/sc› "), F.array_join(F.slice(rest, n + 1, F.size(rest)), " "))))
    return F.struct(F.substring(c, 1, 1).alias("letter"), text.alias("text"))


def mark_run_ins(source: Column, target: Column) -> Column:
    """Mark the first sentence of each target paragraph whose source begins with a short title and a full stop.

    Where the numbers of paragraphs differ, only the first is compared.
    """
    lead = rx(fixed.SENTENCE_TITLE)
    first = rx(fixed.SENTENCE_FIRST)
    ours, theirs = F.split(source, "\n\n", -1), F.split(target, "\n\n", -1)

    def one(en: Column, es: Column) -> Column:
        title = find_all(F.regexp_extract(en, lead, 1), rx(r"[^\s.]\S*"))
        fits = en.rlike(lead) & (F.size(title) <= 5) & F.element_at(title, -1).rlike(r"^\p{Lu}") & ~es.rlike("^[*«‹]") & es.rlike(first)
        marked = F.concat(F.lit("***"), F.regexp_extract(es, first, 1), F.lit("*** "), F.substring(es, F.length(F.regexp_extract(es, first, 0)) + 1, F.length(es)))
        return F.when(F.coalesce(fits, F.lit(False)), marked).otherwise(es)

    same = F.size(ours) == F.size(theirs)
    return F.array_join(F.transform(theirs, lambda es, i: F.when(same | (i == 0), one(F.get(ours, i), es)).otherwise(es)), "\n\n")


def align_damage(source: Column, target: Column) -> Column:
    """Damage phrases of the target take the canonical names of the source's types, in order, if there are as many."""
    kinds = find_all(F.lower(source), rx(rf"\b({alternatives(fixed.DAMAGE)})\s+damage\b"), 1)
    phrase = rx(rf"daño (?:de |por )?(?!(?i:(?:{alternatives(fixed.NOT_DAMAGE)})(?![a-záéíóúñA-ZÁÉÍÓÚÑ])))([a-záéíóúñA-ZÁÉÍÓÚÑ]{{3,}})")
    names = F.create_map(*[F.lit(x) for pair in fixed.DAMAGE.items() for x in pair])

    def aligned(t: Column) -> Column:
        def by(found: Column) -> Column:
            kinds, gaps = found.getField("kinds"), found.getField("gaps")
            joined = F.array_join(F.transform(gaps, lambda g, i: F.when(i == 0, g).otherwise(F.concat(F.lit("daño "), names[F.get(kinds, i - 1)], g))), "")
            return F.when((F.size(kinds) > 0) & (F.size(kinds) == F.size(gaps) - 1), joined).otherwise(t)

        return let(F.struct(kinds.alias("kinds"), F.split(t, phrase, -1).alias("gaps")), by)

    return let(target, aligned)


def map_terms(c: Column, table: dict[str, str]) -> Column:
    """Whole-word substitution, longest term first, whatever the case; then units; no outer space or final stops."""
    for term in sorted(table, key=len, reverse=True):
        c = F.regexp_replace(c, rx(rf"\b{re.escape(term)}\b", "i"), table[term].replace("\\", "\\\\").replace("$", "\\$"))
    for a, b in fixed.UNITS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(F.trim(c), r"\.+$", "")


def replace_in_order(c: Column, table) -> Column:
    """Literal replacements, each on what the one before left."""
    for a, b in table:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape_html(c: Column) -> Column:
    return replace_in_order(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])


def _paragraphs(c: Column, make) -> Column:
    parts = F.filter(F.transform(F.split(c, "\n\n", -1), lambda p: F.regexp_replace(p, rx(r"^\s+|\s+$"), "")), lambda p: p != "")
    return F.array_join(F.transform(parts, make), "")


def _wrap(c: Column, bold_italic: str | None, bold: str, italic: str) -> Column:
    if bold_italic:
        c = F.regexp_replace(c, r"(?s)\*\*\*(.+?)\*\*\*", bold_italic)
    return F.regexp_replace(F.regexp_replace(c, r"(?s)\*\*(.+?)\*\*", bold), r"(?s)\*(.+?)\*", italic)


def html_journal(c: Column) -> Column:
    """Markup as HTML for journals: strong and em, small capitals as a span, forced breaks."""
    t = _wrap(escape_html(c), "<strong><em>$1</em></strong>", "<strong>$1</strong>", "<em>$1</em>")
    t = replace_in_order(t, [("‹sc›", '<span style="font-variant:small-caps">'), ("‹/sc›", "</span>"), ("⏎", "<br>")])
    return _paragraphs(t, lambda p: F.concat(F.lit("<p>"), p, F.lit("</p>")))


def html_page(c: Column) -> Column:
    """Markup as HTML for composed pages: b and i, bullets as a class."""
    t = _wrap(F.replace(escape_html(c), F.lit("&amp;nbsp;"), F.lit("&nbsp;")), "<b><i>$1</i></b>", "<b>$1</b>", "<i>$1</i>")
    t = replace_in_order(t, [("‹sc›", '<span class="sc">'), ("‹/sc›", "</span>")])
    return _paragraphs(t, lambda p: F.concat(F.when(p.startswith("•"), '<p class="bullet">').otherwise("<p>"), p, F.lit("</p>")))


def html_digital(c: Column, definitions: bool = False) -> Column:
    """Markup as HTML for digital pages: lists broken into paragraphs, colours and sizes as spans, stray tokens gone."""
    t = normal_tokens(c)
    t = F.when(count_matches(t, rx(fixed.VALUE_ENTRY)) >= 3, F.regexp_replace(t, rx(fixed.VALUE_BREAK), "$1\n\n")).otherwise(t)
    t = F.when(count_matches(t, fixed.ATTACK_ENTRY) >= 2, F.regexp_replace(t, rx(fixed.ATTACK_BREAK), "\n\n")).otherwise(t)
    t = F.regexp_replace(t, rx(fixed.DEFINITION_BREAK), "\n\n")
    t = F.regexp_replace(escape_html(t), r"(?s)\*\*(.+?)\*\*", "<b>$1</b>")
    t = F.regexp_replace(t, r"(?s)(?<!\*)\*([^*]+?)\*(?!\*)", "<i>$1</i>")
    t = replace_in_order(t, [("‹sc›", '<span style="font-variant:small-caps">'), ("‹/sc›", "</span>")])
    t = F.regexp_replace(t, "‹c:([0-9a-f]{6})›", '<span style="color:#$1">')
    t = replace_in_order(t, [("‹/c›", "</span>"), ("‹g›", '<span style="font-size:1.35em">'), ("‹/g›", "</span>")])
    for pattern in fixed.BROKEN_TOKENS:
        t = F.regexp_replace(t, rx(pattern), "")
    open_tag = "<p class='def'>" if definitions else "<p>"
    return _paragraphs(t, lambda p: F.concat(F.lit(open_tag), p, F.lit("</p>")))


def heading_text(c: Column) -> Column:
    """A heading's text for a journal: style tokens and breaks become spaces, then escaped."""
    return F.trim(escape_html(F.regexp_replace(c, "[‹›/scpb]+?›|⏎", " ")))


def accent_colour(c: Column) -> Column:
    """Whether a packed 24-bit colour is neither grey nor dark."""
    channels = [F.shiftright(c, s).bitwiseAND(F.lit(255)) for s in (16, 8, 0)]
    return (F.greatest(*channels) - F.least(*channels) > 40) & (F.greatest(*channels) > 90)


def front_matter(c: Column) -> Column:
    """Keys and values between the first line of dashes and the next; the later of repeated keys holds."""
    key = lambda x: F.trim(F.substring_index(x, ":", 1))
    value = lambda x: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(x, "^[^:]*:", "")), '^"+|"+$', ""), "^'+|'+$", "")
    later = lambda entries, e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x.getField("k") == e.getField("k"))
    last = lambda entries: F.filter(entries, lambda e, i: ~later(entries, e, i))

    def held(body: Column) -> Column:
        end = F.array_position(F.transform(body, lambda x: F.trim(x)), "---")
        block = let(end, lambda n: F.when(n > 0, F.slice(body, F.lit(1), (n - 1).cast("int"))).otherwise(body))
        entries = F.transform(F.filter(block, lambda x: x.contains(":")), lambda x: F.struct(key(x).alias("k"), value(x).alias("v")))
        return F.map_from_entries(let(entries, last))

    def read(lines: Column) -> Column:
        valid = (F.size(lines) >= 3) & (F.trim(lines[0]) == "---")
        empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
        return F.when(valid, let(F.slice(lines, F.lit(2), F.size(lines)), held)).otherwise(empty)

    return let(F.split(c, "\r\n|\n|\r", -1), read)
