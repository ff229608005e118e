import pytest
from pyspark.sql import functions as F

from epiframe import contract as C
from epiframe.functions import decoders as D

BASE = """
fps: 10
observations:
  - {key: observation.images.top, topic: /cam, type: video, image: {resize: [48, 64]}, align: {method: nearest, tolerance_ms: 100}}
  - {key: observation.state, topic: /joints/a, type: sensor_msgs/JointState, selector: {names: [j1, j2], output_names: [a, b]}}
actions:
  - {key: action, topic: /cmd, type: std_msgs/Float64MultiArray, align: {tolerance_ms: null}}
tasks: [{topic: /task, type: std_msgs/String}]
"""


def test_reads():
    c = C.parse(BASE)
    assert (c.fps, c.name, c.version, c.action_lead_steps) == (10.0, "contract", 1, 0) and len(c.sha256) == 64
    assert c.observations[0].align == C.Align("hold", 200.0) and c.actions[0].align.tolerance_ms is None
    assert c.observations[0].unique_key == "observation.state.joints_a" and c.tasks[0]["key"] == "/task"
    assert c.topics() == ["/joints/a", "/cam", "/cmd", "/task"] and C.missing_topics(c, {"/cam", "/cmd"}) == ["/joints/a", "/task"]
    assert c.by_topic("/cmd").key == "action"
    f = C.features(c, {c.actions[0].unique_key: 3})
    assert f["observation.state"]["names"] == ["a", "b"] and f["action"]["shape"] == [3] and f["observation.images.top"]["dtype"] == "video"


@pytest.mark.parametrize(
    ("old", "new", "why"),
    [
        ("topic: /cmd", "topic: /cmd, role: r", "exactly one"),
        ("topic: /cmd, ", "", "exactly one"),
        ("topic: /cam", "role: cam", "images are bound by topic"),
        ("method: nearest", "method: linear", "interpolated"),
        ("method: nearest", "method: cubic", "none of"),
        ("tolerance_ms: 100", "tolerance_ms: 0", "above 0"),
        ("tolerance_ms: 100", "tol_ms: 100", "no longer"),
        ("tolerance_ms: 100", "strategy: x", "no longer"),
        ("resize: [48, 64]", "depth: {}", "depth"),
        ("output_names: [a, b]", "output_names: [a]", "1 entries for 2"),
        ("output_names: [a, b]", "output_names: [a, a]", "output names must differ"),
        ("topic: /cmd", "topic: /cmd, publish: {}", "publish"),
        ("topic: /cmd", "topic: /cmd, safety_behavior: panic", "safety_behavior"),
        ("key: action", "kay: action", r"actions\[0\]"),
        ("fps: 10", "fps: 0", "fps"),
        ("{topic: /task,", "{", r"tasks\[0\]"),
    ],
)
def test_refusals(old, new, why):
    assert old in BASE
    with pytest.raises(C.ContractError, match=why):
        C.parse(BASE.replace(old, new, 1))


def test_video_keys_must_differ():
    line = "  - {key: observation.images.top, topic: /cam2, type: video, image: {resize: [1, 1]}}\n"
    with pytest.raises(C.ContractError, match="video keys"):
        C.parse(BASE.replace("actions:", line + "actions:"))


@pytest.mark.parametrize(("fps", "tolerances", "want"), [(30, [50, 50], 10**8), (30, [10], 5 * 10**7), (5, [10], 2 * 10**8), (30, [5000], 10**10), (30, [None, 50], 10**9), (30, [], 10**9)])
def test_fetch_buffer(fps, tolerances, want):
    s = tuple(C.Stream(f"k{i}", "", C.Align("hold", t), topic=f"/{i}") for i, t in enumerate(tolerances))
    c = C.Contract("c", 1, float(fps), None, 2, s, (), (), ())
    assert C.fetch_buffer_ns(c) == want
    assert C.scan_window(c, 0, 100) == (-want, 100 + want + 2 * c.step_ns)


@pytest.mark.parametrize(("fps", "want"), [(10, 200000000), (30, 66666666), (100, 50000000)])
def test_online_tolerance(fps, want):
    assert C.online_tolerance_ns(C.Align("hold", None), fps) == want


def test_online_gate():
    c = C.parse(BASE)
    C.check_online(c)
    for t, why in (("{type: resample_uniform}", "later samples"), ("{type: butterworth_lowpass_causal, stage: pre}", "fs_hz"), ("{type: butterworth_lowpass_causal, fs_hz: 9}", "fs_hz")):
        with pytest.raises(C.ContractError, match=why):
            C.check_online(C.parse(BASE.replace("topic: /cmd", f"topic: /cmd, transforms: [{t}]")))


def test_roles():
    c = C.parse(BASE.replace("topic: /joints/a", "role: arm"))
    good = {"arm": [{"path": "a.bag", "topics": {"/x": ["j1", "j2", "j3"], "/y": ["j1"]}}]}
    assert C.bind_roles(c, good).observations[0].topic == "/x"
    for files, why in (({}, "one file, not 0"), ({"arm": good["arm"] * 2}, "not 2"), ({"arm": [{"path": "a", "topics": {"/y": ["j1"]}}]}, "one topic"), ({"arm": [{"path": "a", "topics": {"/y": ["j1", "j2"], "/z": ["j1", "j2"]}}]}, "one topic")):
        with pytest.raises(C.ContractError, match=why):
            C.bind_roles(c, files)


def first(df, col):
    return df.select(col.alias("x")).first().x


def test_decoders(spark):
    js = spark.createDataFrame([(["j1", "j2", "j1"], [1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "name array<string>, position array<double>, velocity array<double>")
    get = lambda *n: first(js, D.decode("sensor_msgs/JointState", js.schema, n))
    assert get("j2", "velocity.j2", "position.j1") == [2.0, 5.0, 3.0] and get() == [1.0, 2.0, 3.0]
    with pytest.raises(Exception, match="missing"):
        get("j9")
    with pytest.raises(KeyError):
        D.decode("sensor_msgs/JointState", js.schema, ("wish.j1",))
    flat = spark.createDataFrame([(1.0, 2.0)], "`linear.x` double, `angular.z` double")
    assert first(flat, D.decode("geometry_msgs/Twist", flat.schema, ("angular.z", "linear.x"))) == [2.0, 1.0]
    nested = spark.sql("SELECT named_struct('x', 1.0, 'y', 2.0, 'z', 3.0) AS linear, named_struct('x', 4.0, 'y', 5.0, 'z', 6.0) AS angular")
    assert first(nested, D.decode("geometry_msgs/Twist", nested.schema)) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    one = spark.createDataFrame([(3,)], "data int")
    assert first(one, D.decode("std_msgs/Float64", one.schema)) == [3.0] and first(one, D.decode("std_msgs/String", one.schema)) == "3"
    many = spark.createDataFrame([([1, 2],)], "data array<int>")
    assert first(many, D.decode("std_msgs/Float32MultiArray", many.schema)) == [1.0, 2.0]
    props = spark.createDataFrame([('{"a": "1.5", "b": "2"}',)], "data string")
    assert first(props, D.decode("string_typed_msg", props.schema, ("b", "a"))) == [2.0, 1.5]
    with pytest.raises(Exception, match="missing"):
        first(props, D.decode("string_typed_msg", props.schema, ("z",)))
    with pytest.raises(ValueError, match="needs selector"):
        D.decode("string_typed_msg", props.schema)
    with pytest.raises(ValueError, match="no decoder"):
        D.decode("nothing", props.schema)


def test_actuators_and_state(spark):
    r = spark.createDataFrame([([{"commanded": {"position": float(i), "velocity": i + 10.0}, "state": {"joint_position": i + 20.0}} for i in range(12)],)], "readings array<struct<commanded:struct<position:double,velocity:double>,state:struct<joint_position:double>>>")
    assert first(r, D.decode("actuator_readings", r.schema, ("LF_HFE", "commanded.velocity.LF_HAA", "state.joint_position.RH_KFE"))) == [1.0, 10.0, 31.0]
    assert first(r, D.decode("actuator_readings", r.schema)) == [float(i) for i in range(12)]
    with pytest.raises(Exception, match="12 readings"):
        first(r.withColumn("readings", F.slice("readings", 1, 11)), D.decode("actuator_readings", r.schema))
    s = spark.sql("SELECT named_struct('name', array('a', 'b'), 'position', array(0D, 1D), 'velocity', array(100D, 101D), 'effort', array(200D, 201D), 'acceleration', array(300D, 301D)) AS joints")
    assert first(s, D.decode("legged_state", s.schema, ("b", "acceleration.a"))) == [1.0, 300.0]


def test_trajectory_points(spark):
    t = spark.sql("SELECT named_struct('stamp', named_struct('sec', 2L, 'nanosec', 5L)) AS header, array('a', 'b') AS joint_names, array(named_struct('positions', array(1D, 2D), 'time_from_start', named_struct('sec', 1, 'nanosec', 7))) AS points")
    p = first(t, D.decode("trajectory_msgs/JointTrajectory", t.schema, ("b",)))[0]
    assert (p.ts, p["values"]) == (3_000_000_012, [2.0])


def test_pictures():
    assert D.rgb_pixels(bytes([1, 2, 3]), 1, 1, "bgr8").tolist() == [[[3, 2, 1]]] and D.rgb_pixels(bytes([9]), 1, 1, "mono8").tolist() == [[[9, 9, 9]]]
    assert D.depth_to_gray([[0.0, 1.0, 2.0, 5.0]], 1, 3).tolist() == [[255, 0, 128, 255]]
    with pytest.raises(ValueError):
        D.rgb_pixels(b"", 0, 0, "yuv")


def test_encoders(spark):
    a = spark.createDataFrame([([1.0, 2.0, 3.0],)], "action array<double>")
    parts = D.split_action(F.col("action"), {"x": 2, "y": 1})
    assert first(a, parts["x"]) == [1.0, 2.0] and first(a, D.ENCODERS["std_msgs/Float64"](parts["y"], ())).data == 3.0
    assert first(a, D.ENCODERS["sensor_msgs/JointState"](parts["x"], ("position.j", "k"))).name == ["j", "k"]
    with pytest.raises(ValueError):
        D.ENCODERS["sensor_msgs/JointState"](parts["x"], ("velocity.j",))
