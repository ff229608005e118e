"""The contract: a YAML document that names streams, what to extract from them and how to align it."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field, replace
from typing import Any

import yaml

from epiframe.operators.asof import METHODS

MS = 1_000_000
#: What an action does when its inputs are stale; the first is the default.
SAFETY = ("publish_nothing", "hold_last", "safe_pose")
TRANSFORM_STAGES = ("pre", "post")


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Align:
    method: str = "hold"
    tolerance_ms: float | None = None


@dataclass(frozen=True)
class Transform:
    type: str
    stage: str = "post"
    params: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Stream:
    key: str
    type: str
    align: Align
    topic: str | None = None
    role: str | None = None
    names: tuple[str, ...] = ()
    output_names: tuple[str, ...] = ()
    transforms: tuple[Transform, ...] = ()
    resize: tuple[int, int] | None = None
    qos: dict[str, Any] | None = None

    @property
    def unique_key(self) -> str:
        return f"{self.key}.{(self.topic or '').lstrip('/').replace('/', '_')}"


@dataclass(frozen=True)
class Contract:
    name: str
    version: int
    fps: float
    robot_type: str | None
    action_lead_steps: int
    observations: tuple[Stream, ...]
    videos: tuple[Stream, ...]
    actions: tuple[Stream, ...]
    tasks: tuple[dict[str, str], ...]
    sha256: str = ""

    @property
    def step_ns(self) -> int:
        return int(1e9 / self.fps)

    def streams(self) -> tuple[Stream, ...]:
        return self.observations + self.videos + self.actions

    def topics(self) -> list[str]:
        return list(dict.fromkeys([s.topic for s in self.streams() if s.topic] + [t["topic"] for t in self.tasks]))

    def by_topic(self, topic: str) -> Stream:
        for s in self.streams():
            if s.topic == topic:
                return s
        raise ContractError(f"no stream of the contract reads topic {topic!r}")


def _align(doc: dict | None, fps: float, image: bool) -> Align:
    default = max(2000.0 / fps, 50.0)
    if doc is None:
        return Align("hold", default)
    for old in ("strategy", "tol_ms"):
        if old in doc:
            raise ContractError(f"align.{old} is no longer read; use align.method and align.tolerance_ms")
    method = doc.get("method", "hold")
    if method not in METHODS:
        raise ContractError(f"align.method {method!r} is none of {', '.join(METHODS)}")
    if image and method == "linear":
        raise ContractError("images cannot be interpolated: align.method linear")
    tolerance = doc.get("tolerance_ms", default)
    if tolerance is not None and not tolerance > 0:
        raise ContractError(f"align.tolerance_ms must be above 0 or null, not {tolerance!r}")
    return Align(method, tolerance)


def _stream(doc: dict, fps: float, what: str) -> Stream:
    image = doc.get("image")
    if (doc.get("topic") is None) == (doc.get("role") is None):
        raise ContractError("exactly one of topic and role is needed")
    if image is not None and doc.get("role") is not None:
        raise ContractError("images are bound by topic, not by role")
    if image is not None and "depth" in image:
        raise ContractError("image.depth is not supported")
    if "publish" in doc:
        raise ContractError("publish is no longer read; name the topic")
    if what == "actions" and doc.get("safety_behavior", SAFETY[0]) not in SAFETY:
        raise ContractError(f"safety_behavior must be one of {', '.join(SAFETY)}")
    selector = doc.get("selector") or {}
    names, outputs = tuple(selector.get("names") or ()), tuple(selector.get("output_names") or ())
    if outputs and len(outputs) != len(names):
        raise ContractError(f"selector.output_names has {len(outputs)} entries for {len(names)} names")
    transforms = []
    for t in doc.get("transforms") or ():
        rest = dict(t)
        stage = rest.pop("stage", "post")
        if stage not in TRANSFORM_STAGES:
            raise ContractError(f"transforms stage {stage!r} is none of {', '.join(TRANSFORM_STAGES)}")
        transforms.append(Transform(rest.pop("type"), stage, rest))
    resize = (image or {}).get("resize")
    return Stream(doc["key"], doc.get("type", ""), _align(doc.get("align"), fps, image is not None), doc.get("topic"), doc.get("role"), names, outputs, tuple(transforms), tuple(resize) if resize else None, doc.get("qos"))


def parse(text: str | bytes) -> Contract:
    """Read a contract; every refusal names the entry at fault."""
    data = text.encode() if isinstance(text, str) else text
    doc = yaml.safe_load(data) or {}
    if not isinstance(doc, dict):
        raise ContractError("a contract is a mapping")
    fps = float(doc.get("fps", 20.0))
    if not fps > 0:
        raise ContractError(f"fps must be above 0, not {fps}")
    made: dict[str, list] = {"observations": [], "videos": [], "actions": []}
    for section in ("observations", "actions"):
        for i, entry in enumerate(doc.get(section) or ()):
            try:
                s = _stream(entry, fps, section)
            except (ContractError, KeyError, TypeError, AttributeError) as e:
                key = entry.get("key", "?") if isinstance(entry, dict) else "?"
                raise ContractError(f"{section}[{i}] ({key}): {e}") from e
            made["videos" if section == "observations" and "image" in entry else section].append(s)
    tasks = []
    for i, t in enumerate(doc.get("tasks") or ()):
        if not isinstance(t, dict) or "topic" not in t:
            raise ContractError(f"tasks[{i}]: topic is missing")
        tasks.append({"key": t.get("key", t["topic"]), "topic": t["topic"], "type": t.get("type", "")})
    keys = [v.key for v in made["videos"]]
    if len(keys) != len(set(keys)):
        raise ContractError(f"video keys must differ: {sorted({k for k in keys if keys.count(k) > 1})}")
    outputs = [n for s in made["observations"] + made["actions"] for n in s.output_names]
    if len(outputs) != len(set(outputs)):
        raise ContractError(f"output names must differ: {sorted({n for n in outputs if outputs.count(n) > 1})}")
    return Contract(
        doc.get("name", "contract"), int(doc.get("version", 1)), fps, doc.get("robot_type"), int(doc.get("action_lead_steps", 0)),
        tuple(made["observations"]), tuple(made["videos"]), tuple(made["actions"]), tuple(tasks), hashlib.sha256(data).hexdigest(),
    )


def load(path: str) -> Contract:
    with open(path, "rb") as f:
        return parse(f.read())


def fetch_buffer_ns(c: Contract) -> int:
    """How far beyond an episode its streams are read: twice the widest tolerance, 50 ms and one frame at least; a second if any is unlimited."""
    tolerances = [s.align.tolerance_ms for s in c.streams()]
    if not tolerances or any(t is None for t in tolerances):
        return 1_000_000_000
    return max(50 * MS, int(1e9 / c.fps), int(2 * max(tolerances) * MS))


def scan_window(c: Contract, start_ns: int, end_ns: int) -> tuple[int, int]:
    """Bounds of the messages that an episode can need; the lead of actions widens the end."""
    pad = fetch_buffer_ns(c)
    return start_ns - pad, end_ns + pad + c.action_lead_steps * c.step_ns


def online_tolerance_ns(align: Align, fps: float) -> int:
    """Online buffers need a bound: an unlimited tolerance becomes two frames, 50 ms at least."""
    if align.tolerance_ms is None:
        return max(int(2e9 / fps), 50 * MS)
    return int(align.tolerance_ms * MS)


def check_online(c: Contract) -> None:
    """Refuse what cannot run sample by sample: only the causal filter, with a declared rate before buffering and the contract's rate after."""
    for s in c.streams():
        for t in s.transforms:
            if s in c.videos:
                raise ContractError(f"{s.key}: no transforms on videos online")
            if t.type != "butterworth_lowpass_causal":
                raise ContractError(f"{s.key}: {t.type} needs later samples and cannot run online")
            fs = t.params.get("fs_hz")
            if t.stage == "pre" and fs is None:
                raise ContractError(f"{s.key}: a filter before buffering must declare fs_hz")
            if t.stage == "post" and fs is not None and float(fs) != c.fps:
                raise ContractError(f"{s.key}: fs_hz {fs} of a filter after sampling must be the contract's {c.fps}")
        if s.align.method not in ("hold", "nearest"):
            raise ContractError(f"{s.key}: online alignment is hold or nearest")


#: Message types that only a recording has, or whose pictures only an offline run can decode.
RECORDED_ONLY = ("video", "avi_video", "mp4_video", "foxglove_msgs/CompressedVideo", "foxglove_msgs/msg/CompressedVideo", "foxglove.CompressedVideo")


def node_refusals(c: Contract) -> list[str]:
    """Why no online node can be made for the contract: all that ``check_online`` refuses, and shapes that only a node knows; empty if one can.

    An action's alignment and the rate of its causal filter do not count, as a node passes actions through.
    """
    from epiframe.functions.decoders import DECODERS, ENCODERS

    causal, why = "butterworth_lowpass_causal", []
    for s in c.streams():
        action, video = s in c.actions, s in c.videos
        if not action and s.align.method not in ("hold", "nearest"):
            why.append(f"{s.key}: online alignment is hold or nearest, not {s.align.method}")
        for t in s.transforms:
            rate = t.params.get("fs_hz")
            if video:
                why.append(f"{s.key}: no transforms on videos online")
            elif t.type != causal:
                why.append(f"{s.key}: {t.type} needs later samples and cannot run online")
            elif not action and t.stage == "pre" and rate is None:
                why.append(f"{s.key}: a filter before buffering must declare fs_hz")
            elif not action and t.stage == "post" and rate is not None and float(rate) != c.fps:
                why.append(f"{s.key}: fs_hz {rate} of a filter after sampling must be the contract's {c.fps}")
        if action and s.type not in ENCODERS:
            why.append(f"{s.key}: no encoder for {s.type!r}")
        if not action and (s.type not in DECODERS or s.type in RECORDED_ONLY):
            why.append(f"{s.key}: messages of type {s.type!r} do not come online")
    for key in {s.key for s in c.actions}:
        own = [s for s in c.actions if s.key == key]
        if len(own) > 1 and not all(s.names for s in own):
            why.append(f"{key}: streams that share an action vector must select names, or their widths are unknown")
    return why


def concat_spec(c: Contract, widths: dict[str, int], key: str, action: bool = False) -> tuple[int, list[str]] | None:
    """Width and names of a base key's whole vector, in order of declaration; None if it has no stream of known width."""
    known = [s for s in (c.actions if action else c.observations) if s.key == key and (s.names or widths.get(s.unique_key))]
    if not known:
        return None
    spec = features(replace(c, observations=tuple(known), actions=(), videos=()), widths)[key]
    return spec["shape"][0], spec["names"]


def bind_roles(c: Contract, files: dict[str, list[dict[str, Any]]]) -> Contract:
    """Give role-bound streams their topic. ``files``: role to files, a file being ``{path, topics: {topic: [paths]}}``.

    A role must name one file, and one topic of it must have all selected paths.
    """

    def bound(s: Stream) -> Stream:
        if s.role is None:
            return s
        there = files.get(s.role, [])
        if len(there) != 1:
            raise ContractError(f"role {s.role!r} of {s.key!r} must match one file, not {len(there)}: {[f['path'] for f in there]}")
        topics = [t for t, paths in there[0]["topics"].items() if set(s.names) <= set(paths)]
        if len(topics) != 1:
            raise ContractError(f"role {s.role!r} of {s.key!r} must match one topic of {there[0]['path']}, not {len(topics)}: {topics}")
        return replace(s, topic=topics[0])

    return replace(c, observations=tuple(map(bound, c.observations)), actions=tuple(map(bound, c.actions)))


def missing_topics(c: Contract, found: set[str]) -> list[str]:
    return [t for t in c.topics() if t not in found]


def features(c: Contract, widths: dict[str, int]) -> dict[str, dict[str, Any]]:
    """Output features by base key: widths and names are concatenated in order of declaration.

    ``widths`` has the width of streams without selected names, by unique key.
    """
    out: dict[str, dict[str, Any]] = {}
    for s in c.observations + c.actions:
        n = len(s.names) or widths.get(s.unique_key, 0)
        names = list(s.output_names or s.names) or [f"{s.unique_key}.{i}" for i in range(n)]
        f = out.setdefault(s.key, {"dtype": "float32", "shape": [0], "names": []})
        f["shape"] = [f["shape"][0] + n]
        f["names"] += names
    for s in c.videos:
        if s.resize is None:
            raise ContractError(f"{s.key}: a video needs image.resize")
        out[s.key] = {"dtype": "video", "shape": [*s.resize, 3], "names": ["height", "width", "channels"]}
    return out
