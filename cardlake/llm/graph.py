"""Small arithmetic graphs run by onnxruntime, in one thread, inside Spark's tasks.

A graph is written as a list of nodes; `session` puts it into the bytes that
the runtime reads (the ONNX format, of which only names, float and integer
tensors and plain attributes are used here).
"""

from __future__ import annotations

from collections.abc import Sequence

try:
    import onnxruntime
except ImportError:  # callers have a plain numpy version
    onnxruntime = None

FLOAT, LONG = 1, 7
_IR, _OPSET = 8, 17
_INT, _TEXT = 2, 3  # kinds of attributes


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | str | bytes) -> bytes:
    """A field of a protocol buffer: an integer, or text or a message with its length."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value & (1 << 64) - 1)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def node(op: str, inputs: Sequence[str], output: str, **attributes: int | str) -> bytes:
    """One operation of a graph: its ONNX name, what it reads, the name of its result."""
    out = b"".join(_field(1, x) for x in inputs) + _field(2, output) + _field(4, op)
    for name, v in attributes.items():
        kind, at = (_INT, 3) if isinstance(v, int) else (_TEXT, 4)
        out += _field(5, _field(1, name) + _field(at, v) + _field(20, kind))
    return _field(1, out)


def _value(number: int, name: str, kind: int, rank: int) -> bytes:
    shape = b"".join(_field(1, _field(2, f"{name}_{k}")) for k in range(rank))
    return _field(number, _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, shape))))


def session(nodes: Sequence[bytes], inputs: dict[str, tuple[int, int]], outputs: dict[str, int]):
    """A runtime session of the nodes. inputs: FLOAT or LONG and the rank by name; outputs (FLOAT): the rank by name."""
    graph = b"".join(nodes) + _field(2, "graph")
    graph += b"".join(_value(11, name, *of) for name, of in inputs.items()) + b"".join(_value(12, name, FLOAT, rank) for name, rank in outputs.items())
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1  # Spark fills the cores
    options.log_severity_level = 3
    model = _field(1, _IR) + _field(8, _field(1, "") + _field(2, _OPSET)) + _field(7, graph)
    return onnxruntime.InferenceSession(model, options, providers=["CPUExecutionProvider"])
