"""Text functions on cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T


@pytest.fixture(scope="module")
def value(spark):
    def run(make, *args):
        row = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
        return row.select(make(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first()["v"]

    return run


CASES = [
    (T.digits_sorted, ("1,2,3 d8",), ["12", "3", "8"]),
    (T.digits_sorted_any, (None,), []),
    (T.dice_and_digits, ("2d6 x 10 1,5",), ["1", "10", "2d6", "5"]),
    (T.decimals_sorted, ("‹c:123456›2,500 1.5‹/c›",), ["1.5", "2,500"]),
    (T.dice_and_numbers, ("ld4 d8 2,500 2500 5’000",), ["1d4", "1d8", "2500", "2500", "5000"]),
    (T.words, ("",), 0),
    (T.words, ("a  b\nc",), 3),
    (T.balanced, ("***a.*** b",), True),
    (T.balanced, ("***a:* b**",), True),
    (T.balanced, ("**x",), False),
    (T.tokens_balanced, ("‹sc›A",), False),
    (T.close_markup, ("**x ",), "**x**"),
    (T.close_markup, ("***x",), "***x***"),
    (T.align_run_in, ("***Name.*** text", "**Nombre.** texto"), "***Nombre.*** texto"),
    (T.repair_markup, ("**A.** b", "**A. b"), "**A. b**"),
    (T.strip_markup_line, ("‹sc›a‹/sc›⏎*b*",), "a b"),
    (T.thousands, ("1.900 y 1.90",), "1,900 y 1.90"),
    (T.join_broken, ("uno,\n\ndos.\n\nTres",), "uno, dos.\n\nTres"),
    (T.slug, ("El Ñu 2",), "el-u-2"),
    (T.title_case, ("o'neil mary-ann 2nd",), "O'Neil Mary-Ann 2Nd"),
    (T.comparable_token, ("‹sc›*Fire*,‹/sc›",), "fire"),
    (T.is_numeric_cell, ("3rd,",), True),
    (T.is_numeric_cell, ("+2/✦",), True),
    (T.is_numeric_cell, ("a1",), False),
    (T.normal_tokens, ("«sc»A«/sc» <C:FF00aa>b</c>",), "‹sc›A‹/sc› <C:FF00aa>b‹/c›"),
    (T.normal_tokens, ("« c : FF00AA »b",), "‹c:ff00aa›b"),
    (T.repair_extraction, ("Diffi culty sci-fi fan ",), "Difficulty sci-fi fan 10"),
    (T.small_caps_heading, ("‹sc›Believer‹/sc›", "«creyente»"), "‹sc›Creyente‹/sc›"),
    (T.small_caps_heading, ("Believer", "creyente"), "creyente"),
    (T.small_caps_run_in, ("‹sc›Storm‹/sc› ‹sc›Strike.‹/sc› When you hit someone", "Golpe de la tormenta. Cuando golpeas"), "‹sc›Golpe de la tormenta.‹/sc› Cuando golpeas"),
    (T.unwrap_answer, ("{'traduccion': 'hola'}",), "hola"),
    (T.unwrap_answer, ('{"a": "short", "b": "a longer text here"}',), "a longer text here"),
    (T.same_as_source, ("A b!", "a, B"), True),
    (T.keep_capitals, ("ABC", "xyz"), "XYZ"),
    (T.keep_capitals, ("Ab", "xyz"), "xyz"),
    (T.is_definition_list, ("**ab:** x **bc.** y ***cd.*** z",), True),
    (T.glossary_root, ("La Bola de fuego (x)",), "fuego"),
    (T.glossary_root, ("Perspicacia",), "perspicaci"),
    (T.longest_alternative, ("el uno / la segunda (x)",), "segunda"),
    (T.term_variants, ("Spell",), ["spell", "spel"]),
    (T.term_variants, ("orc",), ["orc"]),
    (T.name_prefixes, ("Kiran y Toril, Kirin",), ["kira", "tori", "kiri"]),
    (T.restore_chapter, ("CHAPTER 4 | x", "Capítulo | pie"), "Capítulo 4 | pie"),
    (T.restore_chapter, ("CHAPTER 4", "Capítulo 4"), "Capítulo 4"),
    (T.mark_run_ins, ("Development. The plot", "Desarrollo. La trama"), "***Desarrollo.*** La trama"),
    (T.mark_run_ins, ("no title here", "Desarrollo. La trama"), "Desarrollo. La trama"),
    (T.align_damage, ("7 fire damage and 3 cold damage", "7 de daño por fuego y 3 de daño frío"), "7 de daño de fuego y 3 de daño de frío"),
    (T.align_damage, ("7 fire damage", "daño x1 y daño que"), "daño x1 y daño que"),
    (T.html_journal, ("**a** & *b*\n\n‹sc›c‹/sc›",), '<p><strong>a</strong> &amp; <em>b</em></p><p><span style="font-variant:small-caps">c</span></p>'),
    (T.html_page, ("• x\n\n***y***",), '<p class="bullet">• x</p><p><b><i>y</i></b></p>'),
    (T.html_digital, ("‹c:ff0000›a‹/c› ‹sc rest",), '<p><span style="color:#ff0000">a</span></p>'),
    (T.break_lists, ("**Clase** 12 **Puntos** 30",), "**Clase** 12\n\n**Puntos** 30"),
    (T.front_matter, ("---\nname: 'a'\nx: 1:2\nname: b\n---\ny: 3",), {"name": "b", "x": "1:2"}),
    (T.front_matter, ("name: a",), {}),
]


@pytest.mark.parametrize("make, args, want", CASES, ids=lambda v: getattr(v, "__name__", None))
def test_cases(value, make, args, want):
    assert value(make, *args) == want


def test_norm_strips_tokens_marks_and_accents(value):
    assert value(T.norm, "‹sc›Á b‹/sc›  *Ç* \n") == "a b c"


def test_drop_cap_and_contexts(value):
    cut = value(lambda c: T.drop_cap(c), "El cuarto fragmento de la *Vara* x")
    assert (cut["letter"], cut["text"]) == ("E", "‹sc›l cuarto fragmento de‹/sc› la *Vara* x")
    assert value(lambda c: T.context_snippets(c, "b", 2), "aaab\nab") == ["aab a", " ab"]
    assert value(lambda c: T.map_terms(c, {"fire": "fuego", "fire bolt": "saeta"}), "Fire Bolt 30 ft. fire.") == "saeta 30 pies fuego"
