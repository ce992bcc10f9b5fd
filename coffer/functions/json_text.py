"""JSON text columns: arrays of objects and scalar values.

The arguments are SQL names or expressions, so that each helper is one expression
for the planner rather than a tree built call by call from Python.
"""

from pyspark.sql import functions as F

# Text that starts like an object or array is marked before parsing, since a parsed
# text column does not tell {"value":"[12]"} from {"value":[12]}.  The mark is a
# character that stands in front of the bracket, escaped as JSON wants it.
_MARK = r"\u0001"


def marked_sql(json_text):
    """SQL of a JSON text in which string values that start with a bracket carry the mark.

    A quote after a colon after a quote opens a value: inside a string both would be escaped.
    """
    opening = r"""r'("\s*:\s*")(?=[\[{])'"""
    return (
        f"CASE WHEN contains({json_text}, '\"[') OR contains({json_text}, '\"{{') "
        f"THEN regexp_replace({json_text}, {opening}, r'$1\\\\u0001') ELSE {json_text} END"
    )


def scalar_sql(text):
    """SQL of :func:`scalar`, for use inside larger expressions."""
    starts = [f"startswith({text}, '{_MARK}{bracket}')" for bracket in "[{"]
    nested = f"startswith({text}, '{{') OR startswith({text}, '[')"
    return f"CASE WHEN {starts[0]} OR {starts[1]} THEN substring({text}, 2) WHEN NOT ({nested}) THEN {text} END"


def scalar(text):
    """Scalar JSON value as text; objects and arrays give NULL."""
    return F.expr(scalar_sql(text))


def scalar_at(json_text, path):
    """Scalar at ``path`` in a JSON text column; NULL if missing, null or nested."""
    return scalar(f"get_json_object({marked_sql(json_text)}, '{path}')")


def elements(json_text, element):
    """Parse a JSON array of objects; anything but an array gives NULL.

    The parser gives up on a whole array when one element is not an object, so
    such an array is parsed again element by element.  ``coalesce`` is lazy: the
    second pass costs nothing on well-formed rows.
    """
    marked = marked_sql(json_text)
    whole = f"from_json({marked}, 'ARRAY<{element}>')"
    one_by_one = (
        f"transform(from_json({marked}, 'ARRAY<STRING>'), item -> "
        f"CASE WHEN startswith(ltrim(item), '{{') THEN from_json(item, '{element}') END)"
    )
    return F.expr(
        f"CASE WHEN startswith(ltrim({json_text}), '[') THEN coalesce({whole}, {one_by_one}) END"
    )
