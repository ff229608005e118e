"""Decoders and encoders: message columns to value vectors and back, as column expressions.

A decoder takes the table's schema and the selected names and returns a column; missing fields raise when
the plan is made, missing joints when a row shows it. Register others with ``register_decoder``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECODERS: dict[str, Callable[[T.StructType, tuple[str, ...]], Column]] = {}
ENCODERS: dict[str, Callable[[Column, tuple[str, ...]], Column]] = {}
#: Fixed value: the order in which twelve-joint actuator messages list their joints.
ACTUATOR_JOINTS = ("LF_HAA", "LF_HFE", "LF_KFE", "RF_HAA", "RF_HFE", "RF_KFE", "LH_HAA", "LH_HFE", "LH_KFE", "RH_HAA", "RH_HFE", "RH_KFE")


def register_decoder(*types: str):
    def add(f):
        DECODERS.update(dict.fromkeys(types, f))
        return f

    return add


def register_encoder(*types: str):
    def add(f):
        ENCODERS.update(dict.fromkeys(types, f))
        return f

    return add


def decode(kind: str, schema: T.StructType, names: tuple[str, ...] = ()) -> Column:
    if kind not in DECODERS:
        raise ValueError(f"no decoder for {kind!r}; known: {sorted(DECODERS)}")
    return DECODERS[kind](schema, tuple(names))


def path(schema: T.StructType, dotted: str) -> Column:
    """A flattened column of this name if there is one, else a walk through structs."""
    if dotted in schema.fieldNames():
        return F.col(f"`{dotted}`")
    kind: T.DataType = schema
    for part in dotted.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            raise KeyError(f"no field {dotted!r}")
        kind = kind[part].dataType
    return F.col(".".join(f"`{p}`" for p in dotted.split(".")))


def _vector(*cols: Column) -> Column:
    return F.array(*[c.cast("double") for c in cols])


def _by_joint(values: Column, joints: Column, name: str, what: str) -> Column:
    """The value at a joint's place; of joints listed twice the last counts."""
    back = F.array_position(F.reverse(joints), F.lit(name))
    at = (F.size(joints) - back + 1).cast("int")
    bad = F.raise_error(F.lit(f"joint {name!r} or its {what} is missing"))
    return F.when((back == 0) | back.isNull() | (F.size(values) < at), bad.cast("double")).otherwise(F.try_element_at(values, at).cast("double"))


def _joints(prefix: str, fields: tuple[str, ...]):
    def run(schema: T.StructType, names: tuple[str, ...]) -> Column:
        joints = path(schema, f"{prefix}name")
        if not names:
            return path(schema, f"{prefix}{fields[0]}").cast("array<double>")
        cells = []
        for n in names:
            what, _, joint = n.rpartition(".")
            what = what or fields[0]
            if what not in fields:
                raise KeyError(f"{n!r}: field must be one of {', '.join(fields)}")
            cells.append(_by_joint(path(schema, f"{prefix}{what}"), joints, joint, what))
        return F.array(*cells)

    return run


register_decoder("sensor_msgs/JointState", "sensor_msgs/msg/JointState")(_joints("", ("position", "velocity", "effort")))
register_decoder("legged_state", "LeggedState")(_joints("joints.", ("position", "velocity", "effort", "acceleration")))


@register_decoder("trajectory_msgs/JointTrajectory", "trajectory_msgs/msg/JointTrajectory")
def joint_trajectory(schema: T.StructType, names: tuple[str, ...]) -> Column:
    """``array<struct<ts, values>>``: explode it for one row a point; time is the header's plus the point's."""
    base = F.expr("header.stamp.sec * 1000000000L + header.stamp.nanosec")
    joints = path(schema, "joint_names")

    def point(p: Column) -> Column:
        ts = base + p["time_from_start"]["sec"].cast("long") * 1_000_000_000 + p["time_from_start"]["nanosec"].cast("long")
        values = F.array(*[_by_joint(p["positions"], joints, n, "position") for n in names]) if names else p["positions"]
        return F.struct(ts.alias("ts"), values.cast("array<float>").alias("values"))

    return F.transform(path(schema, "points"), point)


@register_decoder("control_msgs/MultiDOFCommand", "control_msgs/msg/MultiDOFCommand")
def multi_dof(schema: T.StructType, names: tuple[str, ...]) -> Column:
    joints = path(schema, "dof_names")
    if not names:
        return F.concat(path(schema, "values").cast("array<double>"), F.coalesce(path(schema, "values_dot"), F.array()).cast("array<double>"))
    cells = []
    for n in names:
        what, _, joint = n.rpartition(".")
        cells.append(_by_joint(path(schema, what or "values"), joints, joint, what or "values"))
    return F.array(*cells)


def _paths(*default: str):
    return lambda schema, names: _vector(*[path(schema, n) for n in (names or default)])


_QUAT, _XYZ = ("x", "y", "z", "w"), ("x", "y", "z")
register_decoder("sensor_msgs/Imu", "sensor_msgs/msg/Imu")(_paths(*[f"orientation.{a}" for a in _QUAT], *[f"angular_velocity.{a}" for a in _XYZ], *[f"linear_acceleration.{a}" for a in _XYZ]))
register_decoder("nav_msgs/Odometry", "nav_msgs/msg/Odometry")(_paths(*[f"pose.pose.position.{a}" for a in _XYZ], *[f"pose.pose.orientation.{a}" for a in _QUAT]))
register_decoder("geometry_msgs/Twist", "geometry_msgs/msg/Twist")(_paths(*[f"linear.{a}" for a in _XYZ], *[f"angular.{a}" for a in _XYZ]))

for _n, _t in (("Float32", "float"), ("Float64", "double"), ("Int32", "int"), ("Int64", "bigint")):
    register_decoder(f"std_msgs/{_n}", f"std_msgs/msg/{_n}")(lambda schema, names, t=_t: F.array(path(schema, "data").cast(t)))
    if _n != "Int64":
        register_decoder(f"std_msgs/{_n}MultiArray", f"std_msgs/msg/{_n}MultiArray")(lambda schema, names, t=_t: path(schema, "data").cast(f"array<{t}>"))


@register_decoder("std_msgs/String", "std_msgs/msg/String")
def string(schema: T.StructType, names: tuple[str, ...]) -> Column:
    return path(schema, "data").cast("string")


@register_decoder("string_typed_msg")
def string_map(schema: T.StructType, names: tuple[str, ...]) -> Column:
    """Numbers by key from a JSON object of strings; the names are needed, a key that is missing raises."""
    if not names:
        raise ValueError("string_typed_msg needs selector names")
    data = F.from_json(path(schema, "data"), "map<string,string>")
    return F.array(*[F.coalesce(F.try_element_at(data, F.lit(n)).cast("double"), F.raise_error(F.lit(f"key {n!r} is missing")).cast("double")) for n in names])


@register_decoder("actuator_readings", "SeActuatorReadings")
def actuators(schema: T.StructType, names: tuple[str, ...]) -> Column:
    """``field.path.joint`` of twelve readings in the fixed joint order; a bare joint is its commanded position."""
    readings = path(schema, "actuator_readings" if "actuator_readings" in schema.fieldNames() else "readings")
    cells = []
    for n in names or ACTUATOR_JOINTS:
        field, _, joint = n.rpartition(".")
        field = field or "commanded.position"
        if joint not in ACTUATOR_JOINTS:
            raise KeyError(f"{n!r}: joint must be one of {', '.join(ACTUATOR_JOINTS)}")
        cell = F.get(readings, F.lit(ACTUATOR_JOINTS.index(joint)))
        for part in field.split("."):
            cell = cell[part]
        cells.append(cell.cast("double"))
    return F.when(F.size(readings) == len(ACTUATOR_JOINTS), F.array(*cells)).otherwise(F.raise_error(F.lit("actuator messages must list 12 readings")).cast("array<double>"))


@register_decoder("sensor_msgs/CompressedImage", "video", "avi_video", "mp4_video", "foxglove_msgs/CompressedVideo", "foxglove_msgs/msg/CompressedVideo", "foxglove.CompressedVideo")
def encoded(schema: T.StructType, names: tuple[str, ...]) -> Column:
    """Encoded pictures stay as they are: the engine aligns them by time and never decodes."""
    return F.struct(path(schema, "format").alias("format"), path(schema, "data").alias("data"))


#: Bytes a pixel of raw picture encodings.
RAW_PIXEL = {"mono8": 1, "8UC1": 1, "rgb8": 3, "bgr8": 3, "rgba8": 4, "bgra8": 4}


@register_decoder("sensor_msgs/Image", "sensor_msgs/msg/Image")
def raw_image(schema: T.StructType, names: tuple[str, ...]) -> Column:
    return F.struct(*[path(schema, n).alias(n) for n in ("height", "width", "encoding", "data")])


def rgb_pixels(data: bytes, height: int, width: int, encoding: str):
    """Raw picture bytes as a (height, width, 3) array of red, green, blue."""
    import numpy as np

    if encoding not in RAW_PIXEL:
        raise ValueError(f"encoding {encoding!r} is none of {', '.join(RAW_PIXEL)}")
    px = np.frombuffer(data, np.uint8).reshape(height, width, RAW_PIXEL[encoding])
    if px.shape[2] == 1:
        return np.repeat(px, 3, axis=2)
    return px[..., :3][..., ::-1] if encoding.startswith("bgr") else px[..., :3]


def depth_to_gray(depth, near: float, far: float, invalid: str | float = "far"):
    """Depths clipped to [near, far] and scaled to 0..255; ``invalid`` (zero or not finite) is near, far, zero, nan or a number."""
    import numpy as np

    d = np.asarray(depth, dtype=float)
    value = {"near": near, "far": far, "zero": 0.0, "nan": np.nan}.get(invalid, invalid) if isinstance(invalid, str) else invalid
    if isinstance(value, str):
        raise ValueError(f"invalid depth policy {invalid!r}")
    d = np.where(np.isfinite(d) & (d > 0), d, value)
    return np.nan_to_num(np.rint((np.clip(d, near, far) - near) / (far - near) * 255)).astype(np.uint8)


def exploded(values: Column, names: tuple[str, ...]) -> list[Column]:
    """One column a name from a vector column."""
    return [F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)]


def suffixed(columns: list[str], key: str, keep: tuple[str, ...] = ()) -> list[Column]:
    """Columns renamed to ``name|key``, so that several streams can stand side by side."""
    return [F.col(f"`{c}`").alias(c if c in keep else f"{c}|{key}") for c in columns]


@register_encoder("sensor_msgs/JointState", "sensor_msgs/msg/JointState")
def to_joint_state(values: Column, names: tuple[str, ...]) -> Column:
    bad = [n for n in names if "." in n and not n.startswith("position.")]
    if bad:
        raise ValueError(f"only positions can be commanded, not {bad}")
    joints = [n.rpartition(".")[2] for n in names]
    return F.struct(F.array(*map(F.lit, joints)).alias("name"), values.cast("array<double>").alias("position"))


@register_encoder("std_msgs/Float64MultiArray", "std_msgs/msg/Float64MultiArray")
def to_array(values: Column, names: tuple[str, ...]) -> Column:
    return F.struct(values.cast("array<double>").alias("data"))


@register_encoder("std_msgs/Float64", "std_msgs/msg/Float64")
def to_scalar(values: Column, names: tuple[str, ...]) -> Column:
    one = F.when(F.size(values) == 1, F.get(values, F.lit(0)).cast("double")).otherwise(F.raise_error(F.lit("a scalar takes one value")).cast("double"))
    return F.struct(one.alias("data"))


def split_action(action: Column, widths: dict[str, int]) -> dict[str, Column]:
    """The part of an action vector that each stream commands, in order, in single precision."""
    out, at = {}, 1
    for name, n in widths.items():
        out[name] = F.slice(action, at, n).cast("array<float>")
        at += n
    return out
