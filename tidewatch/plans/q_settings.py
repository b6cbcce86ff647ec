"""Queries: settings selection, overlay, references, defaults, types, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import settings as s
from ..operators.keyed import latest_by_key
from .registry import query

LATEST_SQL = """
latest AS (SELECT scope, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY scope, key ORDER BY event_id DESC) AS rn
  FROM v_settings) x WHERE rn = 1)
"""


def latest_settings(t):
    return latest_by_key(t.settings, ["scope", "key"], "event_id").select("scope", "key", "value")


@query("prefix_settings", """
SELECT event_id, key, lower(substr(name, 15)) AS log_name FROM (
  SELECT event_id, key, CASE WHEN event_id % 2 = 0 THEN concat('SPARK_LOG_URL_', upper(key))
                             ELSE concat('spark.hadoop.', key) END AS name
  FROM v_settings) x WHERE starts_with(name, 'SPARK_LOG_URL_')
""", "v_settings")
def _(t):
    named = t.settings.select("event_id", "key", F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit(s.LOG_URL_PREFIX), F.upper("key")))
        .otherwise(F.concat(F.lit(s.HADOOP_PREFIX), F.col("key"))).alias("log_name"))
    return s.prefix_settings(named, s.LOG_URL_PREFIX, lower=True, key="log_name")


@query("settings_class", """
SELECT event_id, name,
       CASE WHEN (name LIKE 'spark.%' AND name LIKE '%.port') OR name LIKE 'spark.port.%' THEN 'port'
            WHEN name LIKE 'akka.%' OR name LIKE 'spark.akka%' OR name LIKE 'spark.auth%'
                 OR name LIKE 'spark.ssl%' THEN 'startup' ELSE 'other' END AS class
FROM (SELECT event_id, CASE k % 5 WHEN 0 THEN key WHEN 1 THEN concat('akka.', key)
             WHEN 2 THEN concat('spark.ssl.', CAST(k AS VARCHAR))
             WHEN 3 THEN concat('spark.port.', CAST(k AS VARCHAR))
             ELSE concat('spark.app.', CAST(k AS VARCHAR)) END AS name
      FROM (SELECT v.*, b.k FROM v_settings v JOIN v_beats b ON b.event_id = v.event_id) j) x
""", "v_settings v_beats")
def _(t):
    k = F.col("k")
    text = k.cast("string")
    key = F.concat(F.lit("spark."), text, F.lit(".port"))
    name = (F.when(k % 5 == 0, key).when(k % 5 == 1, F.concat(F.lit("akka."), key))
            .when(k % 5 == 2, F.concat(F.lit("spark.ssl."), text))
            .when(k % 5 == 3, F.concat(F.lit("spark.port."), text))
            .otherwise(F.concat(F.lit("spark.app."), text)))
    return t.beats.select("event_id", name.alias("name")).withColumn(
        "class", s.settings_class(F.col("name")))


@query("overlay_settings", f"""
WITH {LATEST_SQL},
local AS (SELECT scope, key, concat('local ', value) AS value FROM latest WHERE scope % 3 <> 0
          UNION ALL SELECT scope, concat(key, '.max'), 'local max' FROM latest
          WHERE scope % 2 = 0),
remote AS (SELECT scope, key, value FROM latest WHERE scope % 5 <> 0
           UNION ALL SELECT scope, concat(key, '.max'), value FROM latest WHERE scope % 4 <> 1)
SELECT coalesce(l.scope, r.scope) AS scope, coalesce(l.key, r.key) AS key,
       CASE WHEN coalesce(l.key, r.key) LIKE 'spark.%.port' THEN coalesce(l.value, r.value)
            ELSE coalesce(r.value, l.value) END AS value
FROM local l FULL JOIN remote r ON l.scope = r.scope AND l.key = r.key
""", "v_settings")
def _(t):
    latest = latest_settings(t)
    scope = F.col("scope")
    longer = F.concat(F.col("key"), F.lit(".max")).alias("key")
    local = (latest.filter(scope % 3 != 0)
             .select("scope", "key", F.concat(F.lit("local "), F.col("value")).alias("value"))
             .unionByName(latest.filter(scope % 2 == 0)
                          .select("scope", longer, F.lit("local max").alias("value"))))
    remote = (latest.filter(scope % 5 != 0)
              .unionByName(latest.filter(scope % 4 != 1).select("scope", longer, "value")))
    return s.overlay_settings(local, remote, ["scope"])


@query("config_dir_merge", """
SELECT host_id, file_name, priority FROM (
  SELECT host_id, file_name, priority, row_number() OVER (
           PARTITION BY host_id, file_name ORDER BY priority) AS rn
  FROM (SELECT host_id, member_id % 3 AS priority,
               concat('conf-', CAST(k AS VARCHAR), CASE WHEN k % 2 = 0 THEN '.xml' ELSE '.sh' END)
                 AS file_name FROM v_beats) f
  WHERE priority <> 0 OR file_name LIKE '%.xml') x WHERE rn = 1
""", "v_beats")
def _(t):
    k = F.col("k")
    files = t.beats.select("host_id", (F.col("member_id") % 3).alias("priority"), F.concat(
        F.lit("conf-"), k.cast("string"), F.when(k % 2 == 0, ".xml").otherwise(".sh"))
        .alias("file_name"))
    return s.config_dir_merge(files, ["host_id"])


SETS_SQL = """
a AS (SELECT DISTINCT host_id, member_id FROM v_beats WHERE kind = 'failure'),
b AS (SELECT DISTINCT host_id, member_id FROM v_beats WHERE kind = 'remove')
"""


def exclusion_sets(t):
    kind = F.col("kind")
    return (t.beats.filter(kind == "failure").select("host_id", "member_id"),
            t.beats.filter(kind == "remove").select("host_id", "member_id"))


@query("exclusion_union", f"""
WITH {SETS_SQL} SELECT * FROM a UNION SELECT * FROM b
""", "v_beats")
def _(t):
    return s.exclusion_union(*exclusion_sets(t))


@query("exclusion_diff", f"""
WITH {SETS_SQL}
SELECT host_id, member_id, 'add' AS change FROM (SELECT * FROM b EXCEPT SELECT * FROM a) x
UNION ALL SELECT host_id, member_id, 'remove' FROM (SELECT * FROM a EXCEPT SELECT * FROM b) y
""", "v_beats")
def _(t):
    current, wanted = exclusion_sets(t)
    return s.exclusion_diff(current, wanted, ["host_id", "member_id"])


@query("resolve_references", f"""
WITH RECURSIVE {LATEST_SQL},
base AS (SELECT scope, key, CASE WHEN starts_with(value, '$') THEN value
           WHEN CAST(regexp_extract(key, '[0-9]+') AS INT) % 9 = 1
             THEN concat('at ${{spark.', regexp_extract(key, '[0-9]+'), '0.port}} or ${{env:HOME}}')
           WHEN CAST(regexp_extract(key, '[0-9]+') AS INT) = 94 THEN '${{spark.94.port}}!'
           ELSE value END AS value FROM latest),
refs AS (SELECT scope, key, unnest(regexp_extract_all(value, '\\$\\{{([^}}:]+)\\}}', 1)) AS target
         FROM base),
known AS (SELECT r.* FROM refs r JOIN base b ON b.scope = r.scope AND b.key = r.target),
reach AS (SELECT scope, key, target, 1 AS depth FROM known
          UNION SELECT r.scope, r.key, k.target, r.depth + 1 FROM reach r
          JOIN known k ON k.scope = r.scope AND k.key = r.target WHERE r.depth < 6),
cyclic AS (SELECT DISTINCT scope, key FROM reach WHERE depth = 6),
walk AS (SELECT scope, key, value AS text, 0 AS depth FROM base
         UNION ALL
         SELECT w.scope, w.key, regexp_replace(w.text, '\\$\\{{[^}}:]+\\}}', b.value), w.depth + 1
         FROM walk w JOIN base b ON b.scope = w.scope
           AND b.key = regexp_extract(w.text, '\\$\\{{([^}}:]+)\\}}', 1) WHERE w.depth < 6),
final AS (SELECT scope, key, arg_max(text, depth) AS text FROM walk GROUP BY scope, key)
SELECT b.scope, b.key, CASE WHEN c.key IS NULL THEN f.text ELSE b.value END AS value,
       CASE WHEN c.key IS NOT NULL THEN concat('Circular reference in ', b.value) END AS error
FROM base b JOIN final f ON f.scope = b.scope AND f.key = b.key
LEFT JOIN cyclic c ON c.scope = b.scope AND c.key = b.key
""", "v_settings")
def _(t):
    number = F.regexp_extract("key", "[0-9]+", 0)
    value = (F.when(F.startswith(F.col("value"), F.lit("$")), F.col("value"))
             .when(number.cast("int") % 9 == 1, F.concat(
                 F.lit("at ${spark."), number, F.lit("0.port} or ${env:HOME}")))
             .when(number == "94", F.lit("${spark.94.port}!")).otherwise(F.col("value")))
    return s.resolve_references(latest_settings(t).withColumn("value", value))


@query("effective_settings", f"""
WITH {LATEST_SQL},
defs AS (SELECT p_partkey AS n, concat('spark.', CAST(p_partkey AS VARCHAR), '.port') AS key,
         concat('spark.', CAST(p_partkey + 1 AS VARCHAR), '.port') AS alt,
         CASE WHEN p_partkey % 4 <> 0 THEN concat('default ', CAST(p_size AS VARCHAR)) END AS dflt,
         CASE WHEN p_partkey % 4 = 0 THEN concat('spark.', CAST(p_partkey + 2 AS VARCHAR), '.port')
         END AS fallback FROM part),
wanted AS (SELECT DISTINCT member_id AS scope, concat('spark.', CAST(k * 3 AS VARCHAR), '.port')
             AS key FROM v_beats),
chain AS (SELECT d.key, d.key AS c0, d.alt AS c1, f.key AS c2, f.alt AS c3,
                 coalesce(d.dflt, f.dflt) AS dflt
          FROM defs d LEFT JOIN defs f ON f.key = d.fallback)
SELECT w.scope, w.key, coalesce(l0.value, l1.value, l2.value, l3.value, c.dflt) AS value,
       CASE WHEN l0.value IS NOT NULL THEN c0 WHEN l1.value IS NOT NULL THEN c1
            WHEN l2.value IS NOT NULL THEN c2 WHEN l3.value IS NOT NULL THEN c3
            WHEN c.dflt IS NOT NULL THEN 'default' END AS source
FROM wanted w JOIN chain c ON c.key = w.key
LEFT JOIN latest l0 ON l0.scope = w.scope AND l0.key = c.c0
LEFT JOIN latest l1 ON l1.scope = w.scope AND l1.key = c.c1
LEFT JOIN latest l2 ON l2.scope = w.scope AND l2.key = c.c2
LEFT JOIN latest l3 ON l3.scope = w.scope AND l3.key = c.c3
""", "v_settings v_beats")
def _(t):
    n = F.col("p_partkey")

    def port(number):
        return F.concat(F.lit("spark."), number.cast("string"), F.lit(".port"))

    definitions = t.read("part").select(
        port(n).alias("key"), F.array(port(n + 1)).alias("alternatives"),
        F.when(n % 4 != 0, F.concat(F.lit("default "), F.col("p_size").cast("string")))
        .alias("default"), F.when(n % 4 == 0, port(n + 2)).alias("fallback"))
    requested = t.beats.select(F.col("member_id").alias("scope"),
                               port(F.col("k") * 3).alias("key")).distinct()
    return s.effective_settings(requested, definitions, latest_settings(t)).drop("error")


@query("effective_settings_deep", f"""
WITH {LATEST_SQL},
parts AS (SELECT p_partkey AS n, p_partkey // 100 AS chunk, concat('deep.', CAST(p_partkey AS VARCHAR))
            AS key, p_size FROM part),
held AS (SELECT scope, CAST(regexp_extract(key, '[0-9]+') AS INT) AS n, value FROM latest),
wanted AS (SELECT DISTINCT b.member_id AS scope, p.n, p.chunk, p.key FROM v_beats b
           JOIN parts p ON p.n IN (b.k + 1, (b.event_id * 13 + b.k) % (SELECT max(n) FROM parts) + 1)),
hits AS (SELECT w.scope, w.key, arg_min(h.value, h.n) AS value, min(h.n) AS n FROM wanted w
         JOIN held h ON h.scope = w.scope AND h.n >= w.n AND h.n // 100 = w.chunk
           AND (w.chunk % 4 <> 3 OR h.n = w.n)
         JOIN parts p ON p.n = h.n
         GROUP BY w.scope, w.key),
ends AS (SELECT chunk, concat('default ', CAST(p_size AS VARCHAR)) AS dflt FROM parts
         WHERE n = least(chunk * 100 + 99, (SELECT max(n) FROM parts)))
SELECT w.scope, w.key, CASE WHEN w.chunk % 4 = 3 THEN h.value ELSE coalesce(h.value, e.dflt) END AS value,
       CASE WHEN h.value IS NOT NULL THEN concat('deep.', CAST(h.n AS VARCHAR))
            WHEN w.chunk % 4 <> 3 THEN 'default' END AS source,
       CASE WHEN w.chunk % 4 = 3 AND h.value IS NULL THEN 'circular fallback' END AS error
FROM wanted w LEFT JOIN hits h USING (scope, key) JOIN ends e ON e.chunk = w.chunk
""", "v_settings v_beats")
def _(t):
    """Chains of up to a hundred fallbacks; in every fourth hundred of parts they run in a circle."""
    n, chunk = F.col("p_partkey"), F.floor(F.col("p_partkey") / 100)

    def name(number):
        return F.concat(F.lit("deep."), number.cast("string"))

    rows = t.read("part").select("p_partkey", "p_size")
    last = rows.agg(F.max("p_partkey")).first()[0]
    at_end = n == F.least(chunk * 100 + 99, F.lit(last))
    circle = chunk % 4 == 3
    definitions = rows.select(
        name(n).alias("key"), F.array().cast("array<string>").alias("alternatives"),
        F.when(at_end & ~circle, F.concat(F.lit("default "), F.col("p_size").cast("string"))).alias("default"),
        F.when(~at_end, name(n + 1)).when(circle, name(F.greatest(chunk * 100, F.lit(1)))).alias("fallback"))
    held = latest_settings(t).select(
        "scope", name(F.regexp_extract("key", "[0-9]+", 0).cast("bigint")).alias("key"), "value")
    # Every event asks for two keys, a low one and any other.
    asked = F.array(F.col("k") + 1, (F.col("event_id") * 13 + F.col("k")) % last + 1)
    requested = t.beats.select(F.col("member_id").alias("scope"), F.explode(F.transform(asked, name)).alias("key")).distinct()
    return s.effective_settings(requested, definitions, held)


@query("resolve_references_deep", """
WITH parts AS (SELECT p_partkey AS n, p_partkey // 100 AS chunk, p_size, (SELECT max(p_partkey) FROM part) AS m
               FROM part),
ends AS (SELECT chunk, arg_max(p_size, n) AS size, max(n) AS n FROM parts GROUP BY chunk)
SELECT CAST(0 AS BIGINT) AS scope, concat('spark.', CAST(p.n AS VARCHAR)) AS key,
       CASE WHEN p.chunk % 4 = 3 THEN CASE WHEN p.n = e.n THEN concat('<${spark.', CAST(p.chunk * 100 AS VARCHAR), '}')
                                           ELSE concat('<${spark.', CAST(p.n + 1 AS VARCHAR), '}') END
            ELSE concat(repeat('<', CAST(e.n - p.n AS INT)), 'end ', CASE WHEN p.chunk % 4 = 2 THEN 'default'
                 ELSE CAST(e.size AS VARCHAR) END) END AS value,
       CASE WHEN p.chunk % 4 = 3 THEN concat('Circular reference in ',
         CASE WHEN p.n = e.n THEN concat('<${spark.', CAST(p.chunk * 100 AS VARCHAR), '}')
              ELSE concat('<${spark.', CAST(p.n + 1 AS VARCHAR), '}') END) END AS error
FROM parts p JOIN ends e USING (chunk)
""")
def _(t):
    """Chains of up to a hundred references; circles in every fourth hundred; some chains end in a name
    that has only a default, two fallbacks away."""
    n, chunk = F.col("p_partkey"), F.floor(F.col("p_partkey") / 100)

    def name(number):
        return F.concat(F.lit("spark."), number.cast("string"))

    rows = t.read("part").select("p_partkey", "p_size")
    ends = rows.groupBy(chunk.alias("chunk")).agg(F.max("p_partkey").alias("end"))
    value = (F.when(n < F.col("end"), F.concat(F.lit("<${"), name(n + 1), F.lit("}")))
             .when(F.col("chunk") % 4 == 3, F.concat(F.lit("<${"), name(F.col("chunk") * 100), F.lit("}")))
             .when(F.col("chunk") % 4 == 2, F.lit("end ${spark.unset}"))
             .otherwise(F.concat(F.lit("end "), F.col("p_size").cast("string"))))
    settings = rows.withColumn("chunk", chunk).join(ends, "chunk").select(
        F.lit(0).cast("bigint").alias("scope"), name(n).alias("key"), value.alias("value"))
    definitions = t.spark.createDataFrame(
        [("spark.unset", None, "spark.other"), ("spark.other", None, "spark.last"),
         ("spark.last", "${spark.word}", None), ("spark.word", "default", None)],
        "key string, default string, fallback string")
    return s.resolve_references(settings, definitions=definitions)


TYPED_SQL = """
typed AS (SELECT event_id, key, CASE k % 7 WHEN 0 THEN 'int' WHEN 1 THEN 'time' WHEN 2 THEN 'bytes'
            WHEN 3 THEN 'boolean' WHEN 4 THEN 'double' WHEN 5 THEN 'sequence' ELSE 'long' END
            AS type,
          CASE k % 7 WHEN 0 THEN concat(' ', CAST(k AS VARCHAR), CASE WHEN k % 2 = 0 THEN ''
                                        ELSE 'x' END)
            WHEN 1 THEN concat(CAST(k AS VARCHAR), CASE k % 4 WHEN 0 THEN 'min' WHEN 1 THEN 's'
                                 WHEN 2 THEN '' ELSE 'parsec' END)
            WHEN 2 THEN concat('-', CAST(k AS VARCHAR), CASE k % 3 WHEN 0 THEN 'kb' WHEN 1 THEN 'G'
                                 ELSE '' END)
            WHEN 3 THEN CASE k % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'false' ELSE 'yes' END
            WHEN 4 THEN concat(CAST(k AS VARCHAR), '.5')
            WHEN 5 THEN concat(' a, ,b', CAST(k AS VARCHAR), ' ,')
            ELSE CAST(k AS VARCHAR) END AS value, k
          FROM (SELECT event_id, k, concat('spark.', CAST(k AS VARCHAR), '.port') AS key
                FROM v_beats) b)
"""


@query("typed_settings", f"""
WITH {TYPED_SQL}
SELECT event_id, key, type, value, number, real, flag, items,
  CASE WHEN number IS NULL AND real IS NULL AND flag IS NULL AND items IS NULL
       THEN concat(key, ' should be ', type, ', but was ', value) END AS error
FROM (SELECT *, CAST(CASE type WHEN 'int' THEN CASE WHEN k % 2 = 0 THEN k END WHEN 'long' THEN k
    WHEN 'time' THEN CASE k % 4 WHEN 0 THEN k * 60000 WHEN 1 THEN k * 1000 WHEN 2 THEN k END
    WHEN 'bytes' THEN -k * CASE k % 3 WHEN 0 THEN 1024 WHEN 1 THEN 1073741824::BIGINT ELSE 1 END
    END AS BIGINT) AS number,
  CASE WHEN type = 'double' THEN k + 0.5::DOUBLE END AS real,
  CASE WHEN type = 'boolean' THEN CASE k % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END END AS flag,
  CASE WHEN type = 'sequence' THEN concat('a|b', CAST(k AS VARCHAR)) END AS items FROM typed) x
""", "v_beats")
def _(t):
    k = F.col("k")
    text = k.cast("string")
    kind = (F.when(k % 7 == 0, "int").when(k % 7 == 1, "time").when(k % 7 == 2, "bytes")
            .when(k % 7 == 3, "boolean").when(k % 7 == 4, "double")
            .when(k % 7 == 5, "sequence").otherwise("long"))
    value = (F.when(k % 7 == 0, F.concat(F.lit(" "), text, F.when(k % 2 == 0, "").otherwise("x")))
             .when(k % 7 == 1, F.concat(text, F.when(k % 4 == 0, "min").when(k % 4 == 1, "s")
                                        .when(k % 4 == 2, "").otherwise("parsec")))
             .when(k % 7 == 2, F.concat(F.lit("-"), text, F.when(k % 3 == 0, "kb")
                                        .when(k % 3 == 1, "G").otherwise("")))
             .when(k % 7 == 3, F.when(k % 3 == 0, "True").when(k % 3 == 1, "false")
                   .otherwise("yes"))
             .when(k % 7 == 4, F.concat(text, F.lit(".5")))
             .when(k % 7 == 5, F.concat(F.lit(" a, ,b"), text, F.lit(" ,"))).otherwise(text))
    rows = t.beats.select("event_id", F.concat(F.lit("spark."), text, F.lit(".port"))
                          .alias("key"), kind.alias("type"), value.alias("value"))
    return s.typed_settings(rows).withColumn("items", F.array_join("items", "|"))


RENAMED_SQL = """
named AS (SELECT event_id, value, CASE event_id % 10
    WHEN 0 THEN 'spark.files.userClassPathFirst' WHEN 1 THEN 'spark.yarn.user.classpath.first'
    ELSE key END AS key FROM v_settings)
"""


def named_settings(t):
    e = F.col("event_id") % 10
    return t.settings.select("event_id", "value", F.when(
        e == 0, "spark.files.userClassPathFirst").when(
        e == 1, "spark.yarn.user.classpath.first").otherwise(F.col("key")).alias("key"))


@query("deprecated_keys", f"""
WITH {RENAMED_SQL}
SELECT event_id, value, CASE key WHEN 'spark.files.userClassPathFirst'
  THEN 'spark.executor.userClassPathFirst' ELSE key END AS key FROM named
""", "v_settings")
def _(t):
    renamed, _w = s.translate_keys(named_settings(t), s.deprecated_table(t.spark))
    return renamed.select("event_id", "value", "key")


@query("deprecated_warnings", f"""
WITH {RENAMED_SQL}
SELECT DISTINCT key, CASE key WHEN 'spark.files.userClassPathFirst'
  THEN 'spark.executor.userClassPathFirst' END AS new_key, '1.3' AS since
FROM named WHERE key IN ('spark.files.userClassPathFirst', 'spark.yarn.user.classpath.first')
""", "v_settings")
def _(t):
    return s.translate_keys(named_settings(t), s.deprecated_table(t.spark))[1]


@query("validate_split", """
SELECT event_id, host, capacity, CASE WHEN host LIKE '%:%' AND capacity <= 0
         THEN 'host must not contain a port|capacity must be positive'
       WHEN host LIKE '%:%' THEN 'host must not contain a port'
       WHEN capacity <= 0 THEN 'capacity must be positive' END AS errors
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN concat('h:', CAST(user_id AS VARCHAR))
             ELSE concat('h', CAST(user_id AS VARCHAR)) END AS host,
             CAST(floor(value) AS BIGINT) - 20 AS capacity FROM events) x
""")
def _(t):
    user = F.col("user_id").cast("string")
    rows = t.read("events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("h:"), user))
        .otherwise(F.concat(F.lit("h"), user)).alias("host"),
        (F.floor("value").cast("bigint") - 20).alias("capacity"))
    errors = F.array_join("errors", "|")
    return s.checked(rows, {
        "host must not contain a port": s.is_host(F.col("host")),
        "capacity must be positive": F.col("capacity") > 0}).withColumn(
        "errors", F.when(F.size("errors") > 0, errors))
