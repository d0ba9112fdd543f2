"""Event text: trimming, the message of an event, normalization, fingerprint and entity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FP_VERSION = 1
GLOBAL_ENTITY = "__global__"

#: Blank characters that trimming removes (fixed values).
BLANKS = " \t\n\r\x0b\x0c" + "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))

#: Lines that carry no information (fixed values): progress tables of a transfer tool, and stack frames.
PROGRESS_HEAD = r"^\s*%\s+Total\s+%\s+Received"
PROGRESS_SECOND = r"^\s*Dload\s+Upload"
PROGRESS_ROW = r"^\s*\d{1,3}\s+[\d.]+[kMGT]?\s"
STACK_FRAME = r"^\s+at\s.*(?::\d+:\d+\)?|\(native\)|<anonymous>\)?|\(index \d+\))\s*\z"

#: What varies in a message, and its placeholder, in the order of replacement (fixed values).
SCRUBS = (
    (r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?", "<ts>"),
    (r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{1,2}\s+\d{1,2}:\d{2}\b", "<ts>"),
    (r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", "<uuid>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}(?::\d+)?\b", "<ip>"),
    (r"(?i)\bSME\d+\b", "<sme>"),
    (r"(?:\/[\w.+-]+){2,}\/?", "<path>"),
    (r"(?i)\b[0-9a-f]{8,}\b", "<hex>"),
    (r"\d+", "<n>"),
)


def non_blank(c: Column) -> Column:
    """Trimmed, or null if nothing is left."""
    t = F.btrim(c, F.lit(BLANKS))
    return F.when(F.length(t) > 0, t)


def only_string(v: Column, path: str) -> Column:
    """The value at a path of a VARIANT if it is a string, else null; NUL characters are removed."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.translate(F.try_variant_get(v, path, "string"), "\0", ""))


def as_text(v: Column, path: str) -> Column:
    """The value at a path as text: strings as they are, numbers and booleans printed, else ''."""
    return F.coalesce(F.translate(F.try_variant_get(v, path, "string"), "\0", ""), F.lit(""))


def event_text(v: Column) -> Column:
    """The first non-blank string of err_msg, note.message, note.txt and note.skip_reason, else ''."""
    return F.coalesce(*(non_blank(only_string(v, p)) for p in ("$.err_msg", "$.note.message", "$.note.txt", "$.note.skip_reason")), F.lit(""))


def informative_lines(text: Column) -> Column:
    """The lines of ``text`` joined by a blank, without progress tables and stack frames.

    A progress row counts only in a table that its head line opened; any other line closes the table.
    """
    start = F.struct(F.lit(False).alias("in_table"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, line: Column) -> Column:
        head = line.rlike(PROGRESS_HEAD)
        row = state["in_table"] & (line.rlike(PROGRESS_SECOND) | line.rlike(PROGRESS_ROW))
        kept = F.when(head | row | line.rlike(STACK_FRAME), state["kept"]).otherwise(F.array_append(state["kept"], line))
        return F.struct((head | row).alias("in_table"), kept.alias("kept"))

    folded = F.aggregate(F.split(text, r"[\r\n]+"), start, step, lambda s: F.array_join(s["kept"], " "))
    plain = ~text.rlike(r"[\r\n]") & ~text.rlike(PROGRESS_HEAD) & ~text.rlike(STACK_FRAME)  # most messages: no fold needed
    return F.when(plain, text).otherwise(folded)


def normalize(text: Column) -> Column:
    """The message without what varies between its occurrences; null gives ''."""
    out = informative_lines(F.coalesce(text, F.lit("")))
    for pattern, placeholder in SCRUBS:
        out = F.regexp_replace(out, pattern, placeholder)
    return F.lower(F.btrim(F.regexp_replace(out, r"\s+", " "), F.lit(BLANKS)))


def fingerprint(app: Column, func: Column, tag: Column, type_: Column, text: Column) -> Column:
    """SHA-1 over application, function, tag, type and normalized message; bars and backslashes in them are escaped."""

    def part(c: Column) -> Column:
        return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))

    return F.sha1(F.encode(F.concat_ws("|", part(app), part(func), part(tag), part(type_), part(normalize(text))), "utf-8"))


def system_id(c: Column) -> Column:
    """An equipment id in upper case, null for text that is none."""
    t = non_blank(c)
    return F.when(t.rlike(r"(?i)\ASME\d{5}\z"), F.upper(t))


def entity(sme: Column, system: Column) -> Column:
    """What an event is about: its equipment name, else its system id, else all of them."""
    return F.left(F.coalesce(non_blank(sme), non_blank(system), F.lit(GLOBAL_ENTITY)), F.lit(64))
