"""What a Python worker remembers between tasks, under one byte budget.

Python workers outlive tasks and serve one operator after the other, so tables
kept in module globals add up.  Here every remembered table belongs to a group
(an operator).  When a group asks for a table, the tables of all other groups
are released; within a group the least recently asked go first, until the rest
fits ``WORKER_BYTES``.  A table in use is never cut off: it bounds itself (its
``nbytes`` is what it reports).
"""

from __future__ import annotations

import ctypes
from collections import OrderedDict
from collections.abc import Callable, Hashable

import pyarrow as pa

WORKER_BYTES = 256 << 20

_held: OrderedDict[tuple[str, Hashable], object] = OrderedDict()


def held_bytes() -> int:
    return sum(int(getattr(x, "nbytes", 0)) for x in _held.values())


def held(group: str, key: Hashable, build: Callable):
    """The worker's table ``key`` of ``group``, built where it is missing."""
    others = [k for k in _held if k[0] != group]
    for k in others:
        del _held[k]
    if others:
        _give_back()
    if (group, key) not in _held:
        _held[group, key] = build()
    _held.move_to_end((group, key))
    while len(_held) > 1 and held_bytes() > WORKER_BYTES:
        _held.popitem(last=False)
    return _held[group, key]


def release_others(group: str) -> None:
    """Drop what other groups left behind (for operators that keep nothing)."""
    others = [k for k in _held if k[0] != group]
    for k in others:
        del _held[k]
    if others:
        _give_back()


def _give_back() -> None:
    """Return freed memory to the system, where allocators would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)    # glibc only
    if trim:
        trim(0)
