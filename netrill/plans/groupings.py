"""The grouping shapes: which columns they group by and which is their parent."""

from __future__ import annotations

from dataclasses import dataclass

from netrill.schema import CONVERSATION_COLUMNS, EXPORTER_COLUMNS


@dataclass(frozen=True)
class Grouping:
    name: str
    parent: str | None
    own_columns: tuple[str, ...]
    is_total: bool
    metric_prefix: str = ""

    @property
    def columns(self) -> tuple[str, ...]:
        above = GROUPINGS[self.parent].columns if self.parent else ()
        return above + self.own_columns

    @property
    def parent_columns(self) -> tuple[str, ...]:
        return GROUPINGS[self.parent].columns if self.parent else ()

    @property
    def has_dscp(self) -> bool:
        return "dscp" in self.columns

    @property
    def is_host(self) -> bool:
        return self.own_columns == ("address",)

    @property
    def is_conversation(self) -> bool:
        return self.own_columns == CONVERSATION_COLUMNS


EXPORTER = "EXPORTER"
INTERFACE = "EXPORTER_INTERFACE"
APPLICATION = "EXPORTER_INTERFACE_APPLICATION"
CONVERSATION = "EXPORTER_INTERFACE_CONVERSATION"
HOST = "EXPORTER_INTERFACE_HOST"
TOS = "EXPORTER_INTERFACE_TOS"
TOS_APPLICATION = "EXPORTER_INTERFACE_TOS_APPLICATION"
TOS_CONVERSATION = "EXPORTER_INTERFACE_TOS_CONVERSATION"
TOS_HOST = "EXPORTER_INTERFACE_TOS_HOST"

_HOST_COLUMNS = ("address",)
_APPLICATION_COLUMNS = ("application",)

GROUPINGS: dict[str, Grouping] = {
    shape.name: shape
    for shape in (
        Grouping(EXPORTER, None, EXPORTER_COLUMNS, True),
        Grouping(INTERFACE, EXPORTER, ("if_index",), True),
        Grouping(APPLICATION, INTERFACE, _APPLICATION_COLUMNS, False, "BY_APP_"),
        Grouping(CONVERSATION, INTERFACE, CONVERSATION_COLUMNS, False, "BY_CONV_"),
        Grouping(HOST, INTERFACE, _HOST_COLUMNS, False, "BY_HOST_"),
        Grouping(TOS, INTERFACE, ("dscp",), True),
        Grouping(TOS_APPLICATION, TOS, _APPLICATION_COLUMNS, False, "BY_TOS_AND_APP_"),
        Grouping(TOS_CONVERSATION, TOS, CONVERSATION_COLUMNS, False, "BY_TOS_AND_CONV_"),
        Grouping(TOS_HOST, TOS, _HOST_COLUMNS, False, "BY_TOS_AND_HOST_"),
    )
}

# The shapes that a run writes out; plain exporter totals are opt-in.
EMITTED = (
    INTERFACE,
    TOS,
    APPLICATION,
    TOS_APPLICATION,
    HOST,
    TOS_HOST,
    CONVERSATION,
    TOS_CONVERSATION,
)
