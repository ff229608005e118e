"""Queries on the decoders of the remaining message types, on pictures and on column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiframe.functions import decoders as D
from epiframe.functions import pictures
from epiframe.registry import query
from epiframe.sources import tables


def _named(**parts):
    return F.struct(*[(c if not isinstance(c, str) else F.col(c)).alias(n) for n, c in parts.items()])


@query("SELECT l_orderkey, l_linenumber, l_tax AS y, l_discount AS x_dot, l_extendedprice AS last FROM lineitem")
def decode_multi_dof(spark, sf_dir):
    """A command of several degrees of freedom: values by name, rates by a named field, and both as one vector."""
    li = tables.read(spark, sf_dir, "lineitem")
    m = li.select("l_orderkey", "l_linenumber", F.array(F.lit("x"), F.lit("y")).alias("dof_names"), F.array("l_quantity", "l_tax").alias("values"), F.array("l_discount", "l_extendedprice").alias("values_dot"))
    some, all_ = D.decode("control_msgs/MultiDOFCommand", m.schema, ("y", "values_dot.x")), D.decode("control_msgs/MultiDOFCommand", m.schema)
    return m.select("l_orderkey", "l_linenumber", some.alias("v"), F.get(all_, F.lit(3)).alias("last")).select("l_orderkey", "l_linenumber", *D.exploded(F.col("v"), ("y", "x_dot")), "last")


@query("SELECT l_orderkey, l_linenumber, l_quantity AS orientation_x, l_discount AS orientation_w, l_tax AS spin_y, l_extendedprice AS push_z, 10 AS n FROM lineitem")
def decode_imu(spark, sf_dir):
    """An inertial message's ten defaults: orientation, angular velocity, linear acceleration."""
    li, zero = tables.read(spark, sf_dir, "lineitem"), F.lit(0.0)
    m = li.select(
        "l_orderkey", "l_linenumber", _named(x="l_quantity", y=zero, z=zero, w="l_discount").alias("orientation"),
        _named(x=zero, y="l_tax", z=zero).alias("angular_velocity"), _named(x=zero, y=zero, z="l_extendedprice").alias("linear_acceleration"),
    )
    v, at = D.decode("sensor_msgs/Imu", m.schema), {0: "orientation_x", 3: "orientation_w", 5: "spin_y", 9: "push_z"}
    return m.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", *[F.get("v", F.lit(i)).alias(n) for i, n in at.items()], F.size("v").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount AS z, l_tax AS qw, 7 AS n FROM lineitem")
def decode_odometry(spark, sf_dir):
    """An odometry message's seven defaults, three structs deep."""
    li, zero = tables.read(spark, sf_dir, "lineitem"), F.lit(0.0)
    pose = _named(position=_named(x="l_quantity", y=zero, z="l_discount"), orientation=_named(x=zero, y=zero, z=zero, w="l_tax"))
    m = li.select("l_orderkey", "l_linenumber", _named(pose=_named(pose=pose)).alias("pose")).select("l_orderkey", "l_linenumber", F.col("pose.pose").alias("pose"))
    v = D.decode("nav_msgs/Odometry", m.schema)
    return m.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", *[F.get("v", F.lit(i)).alias(n) for i, n in {0: "x", 2: "z", 6: "qw"}.items()], F.size("v").alias("n"))


@query("SELECT vec_id, d AS dim, e::DOUBLE AS v, trunc(e * 1000)::INT AS n FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)")
def decode_multi_array(spark, sf_dir):
    """Arrays of numbers, in the type that the message names."""
    e = tables.read(spark, sf_dir, "embeddings")
    floats = e.select("vec_id", F.col("embedding").alias("data"))
    ints = e.select("vec_id", F.transform("embedding", lambda x: x * F.lit(1000).cast("float")).alias("data"))
    v = floats.select("vec_id", F.posexplode(D.decode("std_msgs/Float32MultiArray", floats.schema)).alias("dim", "v"))
    n = ints.select("vec_id", F.posexplode(D.decode("std_msgs/Int32MultiArray", ints.schema)).alias("dim", "n"))
    return v.join(n, ["vec_id", "dim"]).select("vec_id", "dim", F.col("v").cast("double").alias("v"), "n")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice::FLOAT::DOUBLE AS f32, l_extendedprice AS f64, trunc(l_extendedprice)::INT AS i32, l_orderkey AS i64 FROM lineitem")
def decode_scalars(spark, sf_dir):
    """Messages of one number, in the type that they name."""
    li = tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("data"))
    keys = li.select("l_orderkey", "l_linenumber", F.col("data"), F.col("l_orderkey").alias("key"))
    one = lambda kind: F.get(D.decode(f"std_msgs/{kind}", li.schema), F.lit(0))
    whole = keys.withColumn("price", F.col("data")).withColumn("data", F.col("key"))
    i64 = F.get(D.decode("std_msgs/Int64", whole.schema), F.lit(0))
    rows = keys.select("l_orderkey", "l_linenumber", one("Float32").cast("double").alias("f32"), one("Float64").alias("f64"), one("Int32").alias("i32"), F.col("key"))
    return rows.withColumn("data", F.col("key")).select("l_orderkey", "l_linenumber", "f32", "f64", "i32", i64.alias("i64"))


@query("SELECT c_custkey, c_name AS text, c_acctbal AS a, c_nationkey::DOUBLE AS b FROM customer")
def decode_strings(spark, sf_dir):
    """A text message as it is, and numbers by key out of a JSON message of texts."""
    c = tables.read(spark, sf_dir, "customer")
    typed = F.to_json(F.struct(F.col("c_nationkey").cast("string").alias("b"), F.col("c_acctbal").cast("string").alias("a")))
    m = c.select("c_custkey", F.col("c_name").alias("data"), typed.alias("json"))
    text = m.select("c_custkey", D.decode("std_msgs/String", m.schema).alias("text"), F.col("json").alias("data"))
    v = D.decode("string_typed_msg", text.schema, ("a", "b"))
    return text.select("c_custkey", "text", v.alias("v")).select("c_custkey", "text", *D.exploded(F.col("v"), ("a", "b")))


@query("SELECT l_orderkey, l_linenumber, l_tax AS knee, l_extendedprice AS hip_effort, l_discount AS knee_acceleration FROM lineitem")
def decode_legged(spark, sf_dir):
    """A legged robot's state: fields of joints by name, one struct deep."""
    li = tables.read(spark, sf_dir, "lineitem")
    joints = _named(
        name=F.array(F.lit("hip"), F.lit("knee")), position=F.array("l_quantity", "l_tax"), velocity=F.array("l_tax", "l_tax"),
        effort=F.array("l_extendedprice", "l_quantity"), acceleration=F.array("l_tax", "l_discount"),
    )
    m = li.select("l_orderkey", "l_linenumber", joints.alias("joints"))
    v = D.decode("legged_state", m.schema, ("knee", "effort.hip", "acceleration.knee"))
    return m.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", *D.exploded(F.col("v"), ("knee", "hip_effort", "knee_acceleration")))


@query("SELECT l_orderkey, l_linenumber, l_quantity + 1 AS front, l_quantity * 2 + 11 AS hind, 12 AS n FROM lineitem")
def decode_actuators(spark, sf_dir):
    """Twelve actuator readings in their fixed order: a commanded position, a measured one, and all commands."""
    li = tables.read(spark, sf_dir, "lineitem")
    reading = lambda i: _named(commanded=_named(position=F.col("l_quantity") + i), state=_named(joint_position=F.col("l_quantity") * 2 + i))
    m = li.select("l_orderkey", "l_linenumber", F.array(*map(reading, range(12))).alias("readings"))
    some, all_ = D.decode("actuator_readings", m.schema, ("LF_HFE", "state.joint_position.RH_KFE")), D.decode("actuator_readings", m.schema)
    return m.select("l_orderkey", "l_linenumber", some.alias("v"), F.size(all_).alias("n")).select("l_orderkey", "l_linenumber", *D.exploded(F.col("v"), ("front", "hind")), "n")


@query("""SELECT a.user_id AS scope, a.event_id AS "seq|view", b.event_id AS "seq|click", a.value AS "value|view", b.value AS "value|click" FROM events a JOIN events b ON a.user_id = b.user_id AND a.ts::DATE = b.ts::DATE
WHERE a.event_type = 'view' AND b.event_type = 'click'""")
def suffixed_streams(spark, sf_dir):
    """Streams side by side: their columns carry the stream's key, what they share does not."""
    m = tables.messages(spark, sf_dir).withColumn("day", F.expr("ts div 86400000000000"))
    cols, keep = ["scope", "day", "seq", "value"], ("scope", "day")
    view, click = (m.where(F.col("topic") == t).select(*D.suffixed(cols, t, keep)) for t in ("view", "click"))
    return view.join(click, ["scope", "day"]).select("scope", *[F.col(f"`{c}|{t}`") for c in ("seq", "value") for t in ("view", "click")])


@query("SELECT page_id, 'html' AS format, sha256(html) AS sha, octet_length(encode(html)) AS n FROM pages WHERE html IS NOT NULL AND html <> '' AND page_id % 3 > 0")
def encoded_pictures(spark, sf_dir):
    """Encoded pictures pass as they are; rows without a picture and those of another codec than the stream's are left out."""
    p = tables.read(spark, sf_dir, "pages")
    codec = F.when(F.col("page_id") % 3 == 0, "XML").when(F.col("page_id") % 3 == 1, "HTML").otherwise("html")
    m = p.select("page_id", codec.alias("format"), F.encode("html", "utf-8").alias("data"))
    rows = m.select("page_id", D.decode("foxglove_msgs/CompressedVideo", m.schema).alias("picture"))
    kept, _ = pictures.of_codec(rows, "picture", "html")
    return kept.select("page_id", F.lower("picture.format").alias("format"), F.sha2("picture.data", 256).alias("sha"), F.octet_length("picture.data").alias("n"))


@query("SELECT 'XML' AS format, count(*) AS n FROM pages WHERE html IS NOT NULL AND html <> '' AND page_id % 3 = 0")
def codec_mismatches(spark, sf_dir):
    """Rows that another codec than the stream's keeps out, counted by what they are."""
    p = tables.read(spark, sf_dir, "pages")
    m = p.select(_named(format=F.when(F.col("page_id") % 3 == 0, "XML").otherwise("Html"), data=F.encode("html", "utf-8")).alias("picture"))
    return pictures.of_codec(m, "picture", "html")[1].groupBy(F.col("picture.format").alias("format")).agg(F.count("*").alias("n"))


_HASH = "sha256(coalesce(text, ''))"


@query(f"""SELECT doc_id, 4 AS height, 4 AS width, list_aggregate(list_transform(range(0, 16), lambda i: substr(s, (4 * i + 3)::INT, 1) || substr(s, (4 * i + 2)::INT, 1) || substr(s, (4 * i + 1)::INT, 1)), 'string_agg', '') AS rgb
FROM (SELECT doc_id, {_HASH} AS s FROM documents)""")
def raw_pictures(spark, sf_dir):
    """Raw pictures as red, green, blue bytes: blue comes first in these, and a fourth byte is dropped."""
    d = tables.read(spark, sf_dir, "documents")
    data = F.encode(F.sha2(F.coalesce("text", F.lit("")), 256), "utf-8")
    m = d.select("doc_id", F.lit(4).alias("height"), F.lit(4).alias("width"), F.lit("bgra8").alias("encoding"), data.alias("data"))
    rows = m.select("doc_id", pictures.rgb(D.decode("sensor_msgs/Image", m.schema)).alias("p"))
    return rows.select("doc_id", "p.height", "p.width", F.decode("p.data", "utf-8").alias("rgb"))


@query(f"""SELECT doc_id, list_aggregate(list_transform(range(1, 33), lambda i: substr(s, (2 * i - 1)::INT, 1) || substr(s, (2 * i - 1)::INT, 1) || substr(s, (2 * i - 1)::INT, 1)), 'string_agg', '') AS rgb
FROM (SELECT doc_id, {_HASH} AS s FROM documents)""")
def mono_pictures(spark, sf_dir):
    """A grey byte becomes three; every second byte is one of a row's padding here."""
    d = tables.read(spark, sf_dir, "documents")
    s = F.sha2(F.coalesce("text", F.lit("")), 256)
    data = F.encode(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(63), F.lit(2)), lambda i: F.substr(s, i, F.lit(1))), ""), "utf-8")
    m = d.select("doc_id", F.lit(4).alias("height"), F.lit(8).alias("width"), F.lit("mono8").alias("encoding"), data.alias("data"))
    return m.select("doc_id", F.decode(pictures.rgb(D.decode("sensor_msgs/Image", m.schema))["data"], "utf-8").alias("rgb"))


@query("""SELECT l_orderkey, l_linenumber, round_even((least(greatest(CASE WHEN l_quantity > 0 THEN l_quantity ELSE 40 END, 10), 40) - 10) / 30 * 255, 0)::INT AS near,
round_even((least(greatest(CASE WHEN l_discount > 0 THEN l_discount ELSE 40 END, 10), 40) - 10) / 30 * 255, 0)::INT AS far FROM lineitem""")
def depth_pictures(spark, sf_dir):
    """Depths as grey bytes between a near and a far limit; what is not measured is far."""
    li = tables.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array("l_quantity", "l_discount").alias("d"))
    rows = li.select("l_orderkey", "l_linenumber", pictures.gray(F.col("d"), 10.0, 40.0, "far").alias("g"))
    byte = lambda i: F.conv(F.hex(F.substring("g", i, 1)), 16, 10).cast("int")
    return rows.select("l_orderkey", "l_linenumber", byte(1).alias("near"), byte(2).alias("far"))


@query("""WITH s AS (SELECT doc_id, list_transform(range(0, 4), lambda i: ord(substr(sha256(coalesce(text, '')), i::INT + 1, 1))::DOUBLE) AS g FROM documents)
SELECT doc_id, i AS at, round_even(CASE i % 3 WHEN 0 THEN l WHEN 1 THEN (l + r) / 2 ELSE r END, 0)::INT AS gray
FROM (SELECT doc_id, i, CASE i // 3 WHEN 0 THEN g[1] WHEN 1 THEN (g[1] + g[3]) / 2 ELSE g[3] END AS l, CASE i // 3 WHEN 0 THEN g[2] WHEN 1 THEN (g[2] + g[4]) / 2 ELSE g[4] END AS r FROM s, range(0, 9) t(i))""")
def resized_pictures(spark, sf_dir):
    """Pictures of two by two pixels at three by three, linear between the middles of pixels."""
    d = tables.read(spark, sf_dir, "documents")
    data = F.encode(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 4), "utf-8")
    m = d.select("doc_id", F.lit(2).alias("height"), F.lit(2).alias("width"), F.lit("mono8").alias("encoding"), data.alias("data"))
    big = pictures.resized(pictures.rgb(D.decode("sensor_msgs/Image", m.schema)), 3, 3)
    rows = m.select("doc_id", F.hex(big["data"]).alias("h")).select("doc_id", "h", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("at"))
    return rows.select("doc_id", F.col("at").cast("long").alias("at"), F.conv(F.substr("h", F.col("at") * 6 + 1, F.lit(2)), 16, 10).cast("int").alias("gray"))
