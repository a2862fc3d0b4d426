"""Sources: read, parse and shape each kind of input."""

from netsift.sources import (  # noqa: F401  (importing registers each source)
    blocklists,
    certificates,
    delegations,
    exchanges,
    licences,
    mesh_radio,
    port_scan,
    registry_objects,
    reverse_names,
    transfers,
    web_probe,
    zone,
)
from netsift.sources.base import Source, get_source, register_source, source_names  # noqa: F401
