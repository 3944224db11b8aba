"""Kinds of changelog rows."""

from enum import IntEnum


class RowKind(IntEnum):
    INSERT = 0
    UPDATE_BEFORE = 1
    UPDATE_AFTER = 2
    DELETE = 3

    @property
    def is_add(self) -> bool:
        return self in (RowKind.INSERT, RowKind.UPDATE_AFTER)


ADDS = [int(k) for k in RowKind if k.is_add]
