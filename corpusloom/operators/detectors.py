"""Defects of translated blocks. Every detector takes pairs (page, block, en, es) and returns (page, block, kind, detail).

A null ``es`` is an untranslated block; only :func:`untranslated` looks at those.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from . import joins


def _en() -> Column:
    return F.col("en")


def _es() -> Column:
    return F.col("es")


def translated(pairs: DataFrame) -> DataFrame:
    """Pairs with a live translation: not null, blank or "~"."""
    return pairs.filter(_es().isNotNull() & (F.trim(_es()) != "") & (_es() != "~"))


def _rows(found: DataFrame, kind: str, detail: Column) -> DataFrame:
    return found.select("page", "block", F.lit(kind).alias("kind"), detail.alias("detail"))


def _shown(numbers: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(numbers, ","), F.lit("]"))


def union(found: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


# page sweep


def swept(pairs: DataFrame) -> DataFrame:
    """Pairs that the sweep looks at: no legal notes, three letters or more."""
    return pairs.filter(~T.is_legal_sweep(_en()) & (F.length(T.letters(_en())) >= 3) & (F.length(_en()) > 2))


def untranslated(pairs: DataFrame) -> DataFrame:
    """No translation of a text that is long or holds a common English word."""
    blank = _es().isNull() | (F.trim(_es()) == "")
    english = F.size(T.stopwords_found(_en(), fixed.SWEEP_STOPWORDS)) > 0
    return _rows(swept(pairs).filter(blank & ((F.length(_en()) > 24) | english)), "SIN-TRAD", F.substring(_en(), 1, 70))


def english_sweep(pairs: DataFrame) -> DataFrame:
    """Two English words or more, by occurrence."""
    hits = F.transform(T.stopwords_found(_es(), fixed.SWEEP_STOPWORDS), F.lower)
    found = translated(swept(pairs)).withColumn("hits", hits).filter(F.size("hits") >= 2)
    return _rows(found, "INGLES", F.concat(_shown(F.array_sort(F.array_distinct("hits"))), F.lit(" → "), F.substring(_es(), 1, 60)))


def numbers_sweep(pairs: DataFrame) -> DataFrame:
    """Different numbers, thousands separators aside."""
    found = translated(swept(pairs)).withColumn("a", T.digits_sorted(_en())).withColumn("b", T.digits_sorted_any(_es())).filter(F.col("a") != F.col("b"))
    return _rows(found, "NUMEROS", F.concat(_shown(F.col("a")), F.lit(" vs "), _shown(F.col("b"))))


def stray_tokens(pairs: DataFrame) -> DataFrame:
    """A style token that doesn't close, or closes nothing."""
    return _rows(translated(swept(pairs)).filter(_es().rlike("‹[^›]{0,24}$|^[^‹]{0,24}›|«/|/»")), "TOKEN", F.substring(_es(), 1, 60))


#: Characters by which terms without a whole word meet texts.
GRAM = 3


def strong_terms(glossary: DataFrame) -> DataFrame:
    """Glossary rows (en, es) that are specific enough: several words or a capital, over three characters, not the same."""
    return glossary.filter(((T.words(F.col("en")) > 1) | F.col("en").rlike(r"^\p{Lu}")) & (F.length("en") > 3) & (F.col("en") != F.col("es")))


def _quoted(term: Column) -> Column:
    """A term as a literal inside a pattern."""
    return F.regexp_replace(term, r"([\\.*+?^${}()|\[\]])", r"\\$1")


def _sweep_keys(c: Column) -> Column:
    """Runs of ASCII letters, whole and cut before each capital: a term may end where a capital goes on."""
    runs = F.array_distinct(T.find_all(c, "[A-Za-z]+"))
    cuts = lambda w: F.filter(F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.when((i == F.length(w)) | F.substring(w, i + 1, F.lit(1)).rlike("[A-Z]"), F.substring(w, F.lit(1), i))), lambda p: p.isNotNull())
    return F.array_distinct(F.flatten(F.transform(runs, lambda w: F.when(w.rlike("[A-Za-z][A-Z]"), cuts(w)).otherwise(F.array(w)))))


def _word_keys(c: Column) -> Column:
    return F.array_distinct(T.find_all(c, T.rx(r"\w+")))


def _longest(words: Column) -> Column:
    return F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))).getField("w")


def occurrences(pairs: DataFrame, terms: DataFrame, boundary_left: str, boundary_right: str, lower: bool = False) -> DataFrame:
    """Pairs with each term (columns ``term``, ``target``) that occurs in ``en`` between boundaries.

    Texts and terms meet by equality of a term's longest word, which the boundaries make a whole word of the text, or,
    for terms that begin with neither letter nor digit, of their first characters with a run of as many; only these
    candidates are matched in full. A counted, small set of terms is broadcast and nothing is moved; otherwise words,
    runs and keys of rows meet in a shuffle and the texts are joined to the few that match.
    """
    word = boundary_left == r"\b"
    text = F.lower(_en()) if lower else _en()
    start = T.rx(r"^\w") if word else "^[A-Za-z]"
    head = _longest(T.find_all(F.col("term"), T.rx(r"\w+"))) if word else F.coalesce(_longest(T.find_all(F.col("term"), "[A-Za-z]+(?=[^A-Za-z])")), F.regexp_extract("term", "^[A-Za-z]+", 0))
    own = terms.filter("term <> ''").select("term", "target", F.when(F.col("term").rlike(start), F.nullif(head, F.lit(""))).alias("head"), F.concat(F.lit(f"(?U){boundary_left}"), _quoted(F.col("term")), F.lit(boundary_right)).alias("pattern")).distinct()
    gram = F.concat(F.lit("\x00"), F.substring("term", 1, GRAM))  # no word has this mark
    own = own.withColumn("head", F.coalesce("head", gram))
    few = joins.is_small(own)
    odd = [r["n"] for r in own.filter(F.col("head").startswith("\x00")).select((F.length("head") - 1).alias("n")).distinct().collect()]  # lengths up to GRAM
    keys = _word_keys if word else _sweep_keys
    runs = [F.transform(T.grams(F.col("_text"), n), lambda g: F.concat(F.lit("\x00"), g)) for n in sorted(odd)]
    rows = pairs.withColumn("_text", text)
    each = F.explode(F.concat(keys(F.col("_text")), *runs) if runs else keys(F.col("_text"))).alias("_key")
    full = F.col("_text").contains(F.col("term")) & F.expr("_text rlike pattern")
    if few:
        near = rows.select("*", each).join(F.broadcast(own), F.col("_key") == F.col("head")).drop("_key").filter(full)
    else:
        row = F.struct("page", "block") if "block" in pairs.columns else F.struct("page")
        met = rows.select(row.alias("_row"), each).join(own.hint("merge"), F.col("_key") == F.col("head")).drop("_key").distinct()
        near = rows.join(met.hint("merge"), row == F.col("_row")).drop("_row").filter(full)
    return near.drop("_text", "head", "pattern")


def glossary_sweep(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """A strong term whose target words over three letters are not all there, nor the term itself."""
    terms = strong_terms(glossary).select(F.col("en").alias("term"), F.trim(F.split("es", r"\(")[0]).alias("target"))
    found = occurrences(translated(swept(pairs)), terms, "(?<![A-Za-z])", "(?![a-z])")
    wanted = F.filter(F.split(F.lower("target"), T.rx(r"\W+")), lambda w: F.length(w) > 3)
    lost = (F.size(wanted) > 0) & F.exists(wanted, lambda w: ~F.lower(_es()).contains(w)) & ~F.lower(_es()).contains(F.lower("term"))
    return _rows(found.filter(lost), "GLOSARIO", F.concat("term", F.lit(" → falta «"), "target", F.lit("»")))


# consistency


def numbers(pairs: DataFrame) -> DataFrame:
    """Different numbers, decimals and separators as they stand."""
    found = translated(pairs).withColumn("a", T.decimals_sorted(_en())).withColumn("b", T.decimals_sorted(_es())).filter(F.col("a") != F.col("b"))
    return _rows(found, "NUM", F.concat(F.lit("EN"), _shown(F.col("a")), F.lit(" vs ES"), _shown(F.col("b"))))


def markup(pairs: DataFrame) -> DataFrame:
    """Asterisks or style tokens that don't close; a block may have both."""
    found = translated(pairs)
    stars = _rows(found.filter(~T.balanced(_es())), "MARCADO", F.concat(F.lit("stars: "), F.substring(_es(), 1, 60)))
    tokens = _rows(found.filter(~T.tokens_balanced(_es())), "MARCADO", F.concat(F.lit("tokens: "), F.substring(_es(), 1, 60)))
    return stars.unionByName(tokens)


def length_ratio(pairs: DataFrame, least: int = 60, short: float = 0.45, long: float = 2.0) -> DataFrame:
    """Translations much shorter or longer than their source."""
    long_enough = translated(pairs).filter(F.length(_en()) >= least)  # comparable text is never longer than the text
    sizes = F.struct(F.length(T.norm(_en())).alias("a"), F.length(T.norm(_es())).alias("b"))

    def kind(s: Column) -> Column:
        a, b = s.getField("a"), s.getField("b")
        name = F.when(a >= least, F.when(b < a * short, "CORTO").when(b > a * long, "LARGO"))
        return F.struct(name.alias("kind"), F.concat(b, F.lit("/"), a, F.lit(" chars: "), F.substring(_es(), 1, 60)).alias("detail"))

    found = long_enough.select("page", "block", F.explode_outer(F.filter(F.array(T.let(sizes, kind)), lambda k: k.getField("kind").isNotNull())).alias("k")).filter("k IS NOT NULL")
    return found.select("page", "block", "k.kind", "k.detail")


def english_words(pairs: DataFrame, kept=fixed.KEPT_WORDS) -> DataFrame:
    """Any English word of a set, kept names aside."""
    own = F.array_distinct(T.find_all(T.norm(_es()), "[a-z']+"))
    hits = F.array_sort(F.array_except(F.array_intersect(own, F.array(*[F.lit(w) for w in sorted(set(fixed.CONSISTENCY_STOPWORDS))])), F.array(*[F.lit(w) for w in kept])))
    found = translated(pairs).withColumn("hits", hits).filter(F.size("hits") > 0)
    return _rows(found, "INGLES", F.concat(_shown(F.col("hits")), F.lit(" → "), F.substring(_es(), 1, 60)))


def kept_names(glossary: DataFrame) -> DataFrame:
    """Normalised words of glossary terms whose translation is the same: names that must survive."""
    same = glossary.filter((F.trim("en") != "") & (T.norm(F.col("en")) == T.norm(F.col("es"))))
    return same.select(F.explode(T.find_all(F.col("en"), "[A-Za-z']{5,}")).alias("word")).select(T.norm(F.col("word")).alias("name")).distinct()


def lost_names(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Kept names of the source that the target lacks, in sources of forty characters or more."""
    words = F.array_distinct(T.find_all(T.strip_tokens(_en()), T.rx(r"\b[A-Z][a-z]{3,}\b")))
    long_enough = translated(pairs).filter(F.length(_en()) >= 40)  # comparable text is never longer than the text
    each = long_enough.select("page", "block", "en", "es", F.explode_outer(words).alias("word")).filter("word IS NOT NULL")
    held = joins.looked_up(each.withColumn("plain", T.norm(F.col("word"))), names.select(F.col("name").alias("_n")).distinct(), F.col("plain") == F.col("_n"), "inner")
    # both sides of the join stand in the condition, so comparable texts are made for names only
    gone = held.filter(F.when(F.col("_n").isNotNull(), (F.length(T.norm(_en())) >= 40) & ~T.norm(_es()).contains(F.col("_n"))))
    return gone.groupBy("page", "block").agg(F.array_sort(F.collect_set("word")).alias("gone")).select("page", "block", F.lit("PERDIDO").alias("kind"), _shown(F.col("gone")).alias("detail"))


def divergent(pairs: DataFrame, least: int = 12, sites: int = 4) -> DataFrame:
    """Sources that are translated in more than one way, with their first sites.

    Sources and translations are grouped by their digests; of a source's sites only the first few are kept by a ranked
    limit, which starts before the shuffle, so a passage with countless translations costs no more than any other.
    Two of them show that there is more than one, so comparable texts are made once, and only of sources long enough.
    """
    k = translated(pairs).filter(F.length(_en()) >= least).select("page", "block", T.norm(_en()).alias("source"), T.norm(_es()).alias("target"), F.substring(_es(), 1, 40).alias("es")).filter(F.length("source") >= least)
    keyed = k.select(F.md5("source").alias("key"), F.md5("target").alias("target"), F.struct("page", "block", "es", F.substring("source", 1, 40).alias("source")).alias("site"))
    versions = keyed.groupBy("key", "target").agg(F.min("site").alias("first"))
    ranked = versions.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("first"))).filter(F.col("_n") <= max(sites, 2))
    some = ranked.groupBy("key").agg(F.array_sort(F.collect_list("first")).alias("sites")).filter(F.size("sites") > 1)
    shown = F.array_join(F.transform(F.slice("sites", 1, sites), lambda s: F.concat(F.lit("p"), s.getField("page"), F.lit(":"), s.getField("block"), F.lit("="), s.getField("es"))), " | ")
    top = F.col("sites")[0]
    return some.select(top["page"].alias("page"), top["block"].alias("block"), F.lit("DIVERGE").alias("kind"), F.concat(top["source"], F.lit(" → "), shown).alias("detail"))


# sense


def _sense(pairs: DataFrame, hits, first: str | None = None) -> DataFrame:
    """(page, block, hit) for each of ``hits(en, es)``, an array of strings in which nulls don't count.

    Both comparable texts are computed once for a row; ``first`` is a pattern without which a source has no hit. Arrays
    are exploded as outer ones, as Spark otherwise computes them twice more to leave out rows without an element.
    """
    none = F.array().cast("array<string>")
    found = T.let(T.norm_sense(_en()), lambda en: F.when(F.lit(True) if first is None else en.rlike(first), T.let(T.norm_sense(_es()), lambda es: F.array_compact(hits(en, es)))).otherwise(none))
    return translated(pairs).select("page", "block", F.explode_outer(found).alias("hit")).filter("hit IS NOT NULL")


def false_friends(pairs: DataFrame, rules=fixed.FALSE_FRIENDS) -> DataFrame:
    """A source word together with its cognate. Cognates with accents can't be met, as texts have none here."""
    any_word = T.rx(rf"\b(?:{T.alternatives(w for w, _, _ in rules)})\b")
    checks = lambda en, es: F.array(*[F.when(en.rlike(T.rx(rf"\b{w}\b")) & es.rlike(T.rx(rf"\b{calque}\w*\b")), F.lit(f"{w} → «{calque}» (¿{good}?)")) for w, calque, good in rules])
    return _rows(_sense(pairs, checks, any_word), "FALSO-AMIGO", F.col("hit"))


def lost_negation(pairs: DataFrame) -> DataFrame:
    """The source negates and the target does not."""
    found = translated(pairs).filter(_en().rlike(T.rx(fixed.NEGATION_SOURCE, "i")) & ~_es().rlike(T.rx(fixed.NEGATION_TARGET, "i")) & (F.length(T.norm_sense(_es())) > 30))
    return _rows(found, "NEGACION", F.concat(F.substring(_en(), 1, 55), F.lit(" → "), F.substring(_es(), 1, 55)))


def wrong_condition(pairs: DataFrame, table=fixed.CONDITIONS) -> DataFrame:
    """A condition without its equivalent where another condition's stands."""

    def checks(en: Column, es: Column) -> Column:
        out = []
        for name, own in table:
            others = F.array_compact(F.array(*[F.when(es.contains(t), F.lit(t)) for other, t in table if other != name]))
            out.append(F.when(en.rlike(T.rx(rf"\b{name}\b")) & ~es.contains(own) & (F.size(others) > 0), F.concat(F.lit(f"«{name}» → «"), others[0], F.lit("»"))))
        return F.array(*out)

    return _rows(_sense(pairs, checks, T.rx(rf"\b(?:{T.alternatives(name for name, _ in table)})\b")), "CONDICION", F.col("hit"))


def lost_frequency(pairs: DataFrame, table=fixed.FREQUENCIES) -> DataFrame:
    """A period of use that the target lacks."""
    checks = lambda en, es: F.array(*[F.when(en.rlike(T.rx(pattern)) & ~es.rlike(T.rx(wanted)), F.lit(period)) for pattern, period, wanted in table])
    found = _sense(pairs, checks, T.rx(T.alternatives(f"(?:{pattern})" for pattern, _, _ in table)))
    return _rows(found, "FRECUENCIA", F.concat(F.lit("«"), "hit", F.lit("» ausente")))


def resource_counts(pairs: DataFrame, table=fixed.RESOURCE_PAIRS) -> DataFrame:
    """Counts of paired terms that differ by two or more in all."""

    def checks(en: Column, es: Column) -> Column:
        out = []
        for a, b, ta, tb in table:
            counts = F.struct(*[T.count_matches(c, T.rx(w)).alias(n) for n, c, w in (("na", en, a), ("nb", en, b), ("ma", es, ta), ("mb", es, tb))])

            def differs(k: Column) -> Column:
                na, nb, ma, mb = (k.getField(n) for n in ("na", "nb", "ma", "mb"))
                return F.when((na + nb > 0) & (F.abs(na - ma) + F.abs(nb - mb) >= 2), F.concat_ws("", F.lit("EN "), na, F.lit("/"), nb, F.lit(" vs ES "), ma, F.lit("/"), mb))

            out.append(T.let(counts, differs))
        return F.array(*out)

    return _rows(_sense(pairs, checks, T.rx(T.alternatives(f"(?:{w})" for a, b, _, _ in table for w in (a, b)))), "RECURSO", F.col("hit"))


def range_words(pairs: DataFrame, table=fixed.RANGE_WORDS) -> DataFrame:
    """Ranges named in order on both sides that differ at some place: a reach that a translation has changed."""
    english = T.rx(rf"\b(?:{T.alternatives(w for w, _ in table)})\b")
    spanish = T.rx(rf"\b(?:{T.alternatives(t for _, t in table)})\b")
    names = F.create_map(*[F.lit(x) for pair in table for x in pair])

    def checks(en: Column, es: Column) -> Column:
        both = F.struct(F.transform(T.find_all(en, english), lambda w: names[w]).alias("a"), T.find_all(es, spanish).alias("b"))
        shown = lambda s: F.concat(_shown(s.getField("a")), F.lit(" vs "), _shown(s.getField("b")))
        return F.array(T.let(both, lambda s: F.when(s.getField("a") != s.getField("b"), shown(s))))

    return _rows(_sense(pairs, checks, english), "RANGO", F.col("hit"))


def style_signals(targets: DataFrame, rules=fixed.STYLE_SIGNALS) -> DataFrame:
    """(page, block, kind, detail): every match of every style rule in ``es``, with its surroundings."""
    found = T.let(_es(), lambda es: F.flatten(F.array(*[_signal(es, p, meaning) for p, meaning in rules])))
    return targets.filter(_es().isNotNull()).select("page", "block", F.explode_outer(found).alias("s")).filter("s IS NOT NULL").select("page", "block", F.col("s.kind").alias("kind"), F.col("s.detail").alias("detail"))


def _signal(es: Column, pattern: str, meaning: str) -> Column:
    return F.transform(T.context_snippets(es, T.rx(pattern, "i")), lambda s: F.struct(F.lit(meaning).alias("kind"), s.alias("detail")))


# whole pages: (page, en, es)


def page_english(pages: DataFrame, overrides: DataFrame | None = None, names=()) -> DataFrame:
    """(page, word, n): pages with more than one English word, and how often each occurs.

    ``names``: a project's proper names, in lower case, which don't count. ``overrides`` (page): pages left out.
    """
    allowed = {*fixed.PAGE_ALLOWED, *names}
    stop = sorted(w for w in set(fixed.PAGE_STOPWORDS) if w not in allowed)
    word = pages.select("page", F.explode(T.find_all(F.lower(_es()), "[a-zA-Z']{3,}")).alias("word")).filter(F.col("word").isin(*stop))
    n = word.groupBy("page", "word").agg(F.count("*").alias("n"))
    many = n.groupBy("page").agg(F.sum("n").alias("total")).filter("total > 1").select(F.col("page").alias("_p"))
    out = n.join(many, F.col("page") == F.col("_p"), "left_semi")
    return out.join(overrides.select(F.col("page").alias("_o")), F.col("page") == F.col("_o"), "left_anti") if overrides is not None else out


def page_numbers(pages: DataFrame) -> DataFrame:
    """(page, number, only_en, only_es): numbers that one side of a page has more often than the other."""
    side = lambda c, a, b: pages.select("page", F.explode(T.dice_and_numbers(F.col(c))).alias("number"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    counts = side("en", 1, 0).unionByName(side("es", 0, 1)).groupBy("page", "number").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return counts.filter("a <> b").select("page", "number", F.greatest(F.col("a") - F.col("b"), F.lit(0)).alias("only_en"), F.greatest(F.col("b") - F.col("a"), F.lit(0)).alias("only_es"))


#: Glossary terms too common to look for on pages.
PAGE_TERMS_SKIPPED = ("challenge", "senses", "speed", "scrying")


def page_terms(glossary: DataFrame) -> DataFrame:
    """(term, target): one-piece glossary terms in lower case and the root that must occur."""
    kept = glossary.filter(~F.col("en").rlike(r"[/(]") & (F.length("en") >= 5) & ~F.col("es").contains("/"))
    return kept.select(F.lower("en").alias("term"), T.strip_accents(T.glossary_root(F.col("es"))).alias("target")).filter(~F.col("term").isin(*PAGE_TERMS_SKIPPED))


def page_glossary(pages: DataFrame, glossary: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """(page, term, target): glossary terms of a page whose root its translation lacks; ``skipped`` has (page, term)."""
    found = occurrences(pages, page_terms(glossary), r"\b", r"\b", lower=True).filter(~T.strip_accents(F.lower(_es())).contains(F.col("target"))).select("page", "term", "target")
    if skipped is None:
        return found
    s = skipped.select(F.col("page").alias("_p"), F.col("term").alias("_t"))
    return found.join(s, (F.col("page") == F.col("_p")) & (F.col("term") == F.col("_t")), "left_anti")


def page_signs(pages: DataFrame) -> DataFrame:
    """(page, kind): closing question marks without opening ones, and broken encodings."""
    checks = F.array_compact(F.array(F.when(T.count_matches(_es(), r"\?") > T.count_matches(_es(), "¿") + 1, F.lit("question marks")), F.when(_es().rlike("[ÃÂ�]"), F.lit("mojibake"))))
    return pages.select("page", F.explode(checks).alias("kind"))


def overflow(fit: DataFrame) -> DataFrame:
    """(page, blocks): blocks that don't fit, panels aside."""
    return fit.filter("not fits and block <> '__sb__'").groupBy("page").agg(F.array_sort(F.collect_list("block")).alias("blocks"))


def page_sizes(composed: DataFrame, original: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """(page, width, height, composed_width, composed_height) of pages whose sizes differ by more than ``tolerance``."""
    c = composed.select(F.col("page").alias("_p"), F.col("width").alias("composed_width"), F.col("height").alias("composed_height"))
    far = (F.abs(F.col("width") - F.col("composed_width")) > tolerance) | (F.abs(F.col("height") - F.col("composed_height")) > tolerance)
    return original.join(c, F.col("page") == F.col("_p")).filter(far).drop("_p")


def misaligned(pairs: DataFrame) -> DataFrame:
    """(page, block, reasons): answers that seem to belong to another block, are still English, or lost a chapter number.

    ``pairs`` also has ``type``.
    """
    names = T.name_prefixes(_en())
    es = F.lower(T.strip_accents(_es()))
    rotated = T.let(F.struct(names.alias("n"), es.alias("t")), lambda s: (F.size(s.getField("n")) >= 2) & ~F.exists(s.getField("n"), lambda n: s.getField("t").contains(T.strip_accents(n))))
    english = (F.trim(_es()) == F.trim(_en())) | ((F.length(_es()) > 60) & (F.size(T.stopwords_found(_es(), fixed.ALIGN_STOPWORDS, "")) >= 4))
    chapter = F.regexp_extract(_en(), T.rx(r"CHAPTER\s+(\d+)", "i"), 1)
    footer = (F.col("type") == "footer") & (chapter != "") & ~_es().contains(chapter)
    reasons = F.array_compact(F.array(F.when(rotated, F.lit("names")), F.when(english & (F.trim(_es()) != ""), F.lit("english")), F.when(footer, F.lit("chapter"))))
    return pairs.select("page", "block", reasons.alias("reasons")).filter(F.size("reasons") > 0)


# guards: whether a new text may replace an old one


def revision_accepted(old: Column, new: Column) -> Column:
    """Same numbers and markup, and 0.75 to 1.3 times the length."""
    same = lambda p: T.count_matches(old, p) == T.count_matches(new, p)
    ratio = F.length(new) / F.greatest(F.lit(1), F.length(old))
    return (F.trim(new) != "") & (T.digits_sorted(old) == T.digits_sorted(new)) & same(r"\*\*") & same("‹sc›") & ratio.between(0.75, 1.3)


def shortening_accepted(old: Column, new: Column, terms: Column) -> Column:
    """Same numbers, and no term of the array lost that the old text had."""
    lost = F.exists(terms, lambda t: F.lower(old).contains(F.lower(t)) & ~F.lower(new).contains(F.lower(t)))
    return (F.trim(new) != "") & (T.digits_sorted(old) == T.digits_sorted(new)) & ~lost


def segmentation_accepted(section: Column, covered: Column) -> Column:
    """Few numbers of a section that its entries don't cover, and hardly any English."""
    wanted, have = T.dice_and_digits(section), T.dice_and_digits(covered)
    missing = F.size(F.filter(wanted, lambda n: ~F.array_contains(have, n)))
    english = F.size(T.stopwords_found(covered, fixed.SEGMENT_STOPWORDS, ""))
    return (missing <= F.greatest(F.lit(1), F.floor(F.size(wanted) / 12))) & (english < 3)


# documented checks on composed pages


def orphans(blocks: DataFrame, translations: DataFrame, allowed: DataFrame) -> DataFrame:
    """Blocks without any entry that nothing absorbs (``allowed``: page, block)."""
    seen = translations.select("page", "block").unionByName(allowed.select("page", "block")).select(F.col("page").alias("_p"), F.col("block").alias("_b"))
    return blocks.join(seen, (F.col("page") == F.col("_p")) & (F.col("block") == F.col("_b")), "left_anti")


def canonical_versions(versions: DataFrame) -> DataFrame:
    """Of each source's translations (source, target, priority) the one of highest priority, the first by text among equals."""
    return versions.groupBy("source").agg(F.min(F.struct("priority", "target")).getField("target").alias("target"))


def repeated_neighbours(pairs: DataFrame) -> DataFrame:
    """Long translations whose neighbour's text occurs in them: the sign of a doubled segment."""
    from pyspark.sql import Window

    w = Window.partitionBy("page").orderBy("block")
    long = length_ratio(pairs).filter("kind = 'LARGO'").select(F.col("page").alias("_p"), F.col("block").alias("_b"))
    around = pairs.withColumn("before", F.lag("es").over(w)).withColumn("after", F.lead("es").over(w))
    hit = F.coalesce(_es().contains(F.col("before")) & (F.length("before") > 0), F.lit(False)) | F.coalesce(_es().contains(F.col("after")) & (F.length("after") > 0), F.lit(False))
    return around.filter(hit).join(long, (F.col("page") == F.col("_p")) & (F.col("block") == F.col("_b")), "left_semi").select("page", "block")


def stem_present(target: Column, term: Column) -> Column:
    """Whether the first four letters of a term occur: such glossary findings are mostly inflections."""
    return T.strip_accents(F.lower(target)).contains(F.substring(T.strip_accents(F.lower(term)), 1, 4))
