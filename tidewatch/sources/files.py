"""File readers and writers: gzip JSON entities, whole files, ``key=value`` files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import trim_keep_crlf

# Microseconds survive the text form.
TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# The form of property files.
PROPERTY_LINE = r"(?s)^[\t\f ]*((?:\\.|[^\\=:\t\f ])*+)[\t\f ]*+[=:]?[\t\f ]*+(.*)$"
COMMENT_OR_BLANK = r"(?s)^[\t\f ]*+(?:[#!].*)?$"
LOGICAL_LINE = r"(?:^|(?<=[\r\n]))[\t\f ]*+[#!][^\r\n]*+|(?:[^\\\r\n]++|\\(?:\r\n|[\s\S]))++"
CONTINUED = r"\\(?:\r\n|\r|\n)[\t\f ]*+"
UNICODE_ESCAPES = r"^(?:\\u[0-9A-Fa-f]{4})+$"
ESCAPED_TOKEN = r"(?s)(?:\\u[0-9A-Fa-f]{4})++|\\.|[^\\]++"


def write_entities(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store entities as gzip-compressed JSON lines."""
    (df.write.mode(mode).options(**TIME_OPTIONS)
     .option("compression", "gzip").option("ignoreNullFields", "true").json(path))


def read_entities(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read entities back with the schema of their class."""
    return spark.read.schema(schema).options(**TIME_OPTIONS).json(path)


def read_whole_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row per file: its path and its whole content."""
    return (spark.read.options(**options).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def logical_lines(content: Column) -> Column:
    """The property lines of a whole file: comments and blank lines are left out, and a line that ends
    in a backslash goes on in the next one, without that one's leading blanks."""
    lines = F.regexp_extract_all(content, F.lit(LOGICAL_LINE), F.lit(0))
    told = F.filter(lines, lambda line: ~line.rlike(COMMENT_OR_BLANK))
    return F.transform(told, lambda line: F.regexp_replace(line, CONTINUED, ""))


def unescaped(text: Column) -> Column:
    """Escapes replaced: ``\\n \\r \\t \\f``, ``\\uXXXX``, and any other character for itself."""
    def plain(token: Column) -> Column:
        code = F.decode(F.unhex(F.regexp_replace(token, r"\\u", "")), "UTF-16BE")
        other = F.substring(token, 2, 1)
        named = F.when(other == "n", "\n").when(other == "r", "\r").when(other == "t", "\t").when(
            other == "f", "\f").otherwise(other)
        return (F.when(~F.startswith(token, F.lit("\\")), token)
                .when(token.rlike(UNICODE_ESCAPES), code).otherwise(named))

    tokens = F.regexp_extract_all(text, F.lit(ESCAPED_TOKEN), F.lit(0))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(tokens, plain), "")).otherwise(text)


def parse_properties(lines: DataFrame, body: str = "value") -> DataFrame:
    """Property lines to (key, value) rows; blank and comment lines are dropped.

    The key ends at the first ``=``, ``:`` or blank that is not escaped. Values are trimmed of characters up
    to the space, but an escaped line end in them is kept.
    """
    kept = [c for c in lines.columns if c != body]
    return (lines.filter(~F.col(body).rlike(COMMENT_OR_BLANK))
            .select(*kept, unescaped(F.regexp_extract(body, PROPERTY_LINE, 1)).alias("key"),
                    trim_keep_crlf(unescaped(F.regexp_extract(body, PROPERTY_LINE, 2))).alias("value")))


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of all property files below ``path``; each file is read as a whole."""
    content = read_whole_files(spark, path)
    return parse_properties(content.select(F.explode(logical_lines(F.col("content"))).alias("value")))
