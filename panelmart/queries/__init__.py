"""Registered queries (import side effect: fills ``panelmart.registry.REGISTRY``)."""

from . import panel_q  # noqa: F401
from . import aggregate_q  # noqa: F401
from . import merge_q  # noqa: F401
from . import bridge_q  # noqa: F401
from . import funnel_q  # noqa: F401
from . import quality_q  # noqa: F401
from . import ingest_q  # noqa: F401
from . import harness_q  # noqa: F401
from . import charts_q  # noqa: F401
from . import sources_q  # noqa: F401
from . import quality_found_q  # noqa: F401
