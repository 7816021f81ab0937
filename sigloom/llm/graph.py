"""Computations as onnxruntime graphs: many small products and maps in one call, on one thread.

``Graph`` writes the few protobuf fields of ONNX that are needed here (models are made in the process
that runs them, never read from files).
"""

from __future__ import annotations

import numpy as np

_KINDS = {np.dtype(np.float32): 1, np.dtype(np.int32): 6, np.dtype(np.int64): 7, np.dtype(np.float64): 11}
IR_VERSION, OPSET = 8, 17


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1  # negative numbers take ten bytes
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _value(name: str, kind: int, shape: tuple[int | str, ...]) -> bytes:
    dims = b"".join(_field(1, _field(1, d) if isinstance(d, int) else _field(2, d)) for d in shape)
    return _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, dims)))


class Graph:
    """Names of values in, names of values out; ``session`` compiles what was added."""

    def __init__(self):
        self.nodes, self.constants, self.inputs, self.outputs = [], [], [], []

    def input(self, name: str, dtype, *shape: int | str) -> str:
        """Sizes of ``shape`` that are names are free."""
        self.inputs.append(_value(name, _KINDS[np.dtype(dtype)], shape))
        return name

    def constant(self, value: np.ndarray) -> str:
        value = np.ascontiguousarray(value)
        name = f"c{len(self.constants)}"
        dims = b"".join(_field(1, n) for n in value.shape)
        self.constants.append(dims + _field(2, _KINDS[value.dtype]) + _field(8, name) + _field(9, value.tobytes()))
        return name

    def __call__(self, op: str, *inputs: str, **attributes: int | str | list[int]) -> str:
        name = f"v{len(self.nodes)}"
        parts = [*(_field(1, x) for x in inputs), _field(2, name), _field(4, op)]
        for key, x in attributes.items():
            if isinstance(x, int):
                held = _field(3, x) + _field(20, 2)
            elif isinstance(x, str):
                held = _field(4, x) + _field(20, 3)
            else:
                held = b"".join(_field(8, i) for i in x) + _field(20, 7)
            parts.append(_field(5, _field(1, key) + held))
        self.nodes.append(b"".join(parts))
        return name

    def output(self, value: str, dtype, *shape: int | str) -> None:
        self.outputs.append(_value(value, _KINDS[np.dtype(dtype)], shape))

    def session(self):
        import onnxruntime

        body = b"".join(
            [
                *(_field(1, x) for x in self.nodes),
                _field(2, "graph"),
                *(_field(5, x) for x in self.constants),
                *(_field(11, x) for x in self.inputs),
                *(_field(12, x) for x in self.outputs),
            ]
        )
        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = options.inter_op_num_threads = 1
        options.log_severity_level = 3
        model = _field(1, IR_VERSION) + _field(7, body) + _field(8, _field(1, "") + _field(2, OPSET))
        return onnxruntime.InferenceSession(model, options, providers=["CPUExecutionProvider"])
