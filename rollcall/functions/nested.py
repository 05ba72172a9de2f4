"""Union-typed ids, localised texts and answer choices kept in JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import as_column, blank_to_null

LABELS = "map<string,string>"

# What JSON allows around a value.
JSON_BLANKS = " \t\r\n"
# Keys that may hold the options of a question, best first.
OPTION_KEYS = ("options", "choices", "answers", "options_list", "question_options")
# Keys that may hold the text of one option, best first.
TEXT_KEYS = ("label", "text", "answer", "name", "title", "display")
# Languages of a translated text, best first.
TEXT_LANGUAGES = ("de", "de-DE", "en", "en-US")


def pick_label(labels: Column | str, language: str = "de") -> Column:
    """Text in the wanted language; if missing or empty, the first text there is."""
    m = as_column(labels)
    return F.coalesce(
        F.nullif(F.try_element_at(m, F.lit(language)), F.lit("")),
        F.get(F.map_values(m), F.lit(0)),
    )


def _opening(text: Column) -> Column:
    """The first character of a JSON text; text that begins visibly, as most does, is not trimmed."""
    visible = (text >= "!") & (text < "\x80")
    return F.substring(F.when(visible, text).otherwise(F.ltrim(text, F.lit(JSON_BLANKS))), 1, 1)


def embedded(c: Column | str, name_key: str = "name") -> Column:
    """An id-or-object JSON value read as ``struct<id, name>``; null for a bare id.

    A bare id is not given to the parser, to which it is a broken record that costs an exception.
    """
    text = as_column(c)
    return F.when(_opening(text).isin("{", "["), F.from_json(text, f"id bigint, `{name_key}` {LABELS}"))


def union_id(c: Column | str) -> Column:
    """The id of a JSON value that is either the id or an object holding it.

    A failed cast costs an exception, so that none is tried on an object.
    """
    text = as_column(c)
    inside = F.get_json_object(text, "$.id").try_cast("bigint")
    return F.when(_opening(text) == "{", inside).otherwise(F.coalesce(text.try_cast("bigint"), inside))


def variant_id(c: Column | str) -> Column:
    """The same for a VARIANT value."""
    v = as_column(c)
    return F.coalesce(F.try_variant_get(v, "$.id", "bigint"), F.try_variant_get(v, "$", "bigint"))


def typed_fields(json: Column | str) -> Column:
    """Fields of a JSON object in document order: key, raw text, kind."""
    text = as_column(json)
    return F.transform(
        F.arrays_zip(
            F.map_entries(F.from_json(text, LABELS)).alias("texts"),
            F.map_entries(F.from_json(text, "map<string,variant>")).alias("kinds"),
        ),
        lambda e: F.struct(
            e["texts"]["key"].alias("key"),
            e["texts"]["value"].alias("text"),
            F.schema_of_variant(e["kinds"]["value"]).alias("kind"),
        ),
    )


def typed_items(json: Column | str) -> Column:
    """Items of a JSON array in order: raw text, kind."""
    text = as_column(json)
    return F.transform(
        F.arrays_zip(
            F.from_json(text, "array<string>").alias("texts"),
            F.from_json(text, "array<variant>").alias("kinds"),
        ),
        lambda e: F.struct(
            e["texts"].alias("text"), F.schema_of_variant(e["kinds"]).alias("kind")
        ),
    )


def _first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _texts(fields: Column) -> Column:
    """Texts of the string fields; null where the field is blank or no string."""
    return F.transform(
        fields, lambda f: F.when(f["kind"] == "STRING", blank_to_null(f["text"]))
    )


def _named(fields: Column, key: Column | str) -> Column:
    return F.filter(fields, lambda f: f["key"] == key)


def option_items(fields: Column | str) -> Column:
    """The options among the fields of a question, as ``array<struct<text, kind>>``.

    The first known key that holds a list wins. If that list is empty or there is
    none, the first list of texts or objects anywhere in the document is taken.
    """
    lists = F.filter(as_column(fields), lambda f: f["kind"].startswith("ARRAY"))
    known = typed_items(F.coalesce(*[_first(_named(lists, k))["text"] for k in OPTION_KEYS]))
    candidates = F.filter(
        F.transform(lists, lambda f: typed_items(f["text"])),
        lambda items: F.coalesce(_first(items)["kind"].rlike("^(STRING|OBJECT)"), F.lit(False)),
    )
    return F.coalesce(F.when(F.size(known) > 0, known), _first(candidates))


def option_label(fields: Column | str) -> Column:
    """Readable text among the fields of one option; null if it has none.

    Known keys come first. Each may hold the text itself or its translations, of
    which the preferred languages come before any other.
    """
    own = as_column(fields)

    def translated(field: Column) -> Column:
        per_field = F.transform(
            F.array(typed_fields(F.when(field["kind"].startswith("OBJECT"), field["text"]))),
            lambda languages: F.concat(
                F.flatten(
                    F.transform(
                        F.array(*[F.lit(x) for x in TEXT_LANGUAGES]),
                        lambda language: _texts(_named(languages, language)),
                    )
                ),
                _texts(languages),
            ),
        )
        return F.coalesce(_first(per_field), F.array().cast("array<string>"))

    ranked = F.flatten(
        F.transform(
            F.array(*[F.lit(x) for x in TEXT_KEYS]),
            lambda key: F.flatten(
                F.transform(
                    _named(own, key), lambda f: F.concat(_texts(F.array(f)), translated(f))
                )
            ),
        )
    )
    return _first(F.filter(F.concat(ranked, _texts(own)), lambda t: t.isNotNull()))
