"""Sports games, betting odds, weather and news analytics as Spark DataFrame operators.

Every operator is ``DataFrame -> DataFrame`` (or ``Column -> Column``), lazy, and free of driver-side
loops over data.  The same functions serve batch tables and Structured Streaming queries.
"""

from matchgrid import functions, operators, plans, sources, streaming
from matchgrid.params import SPORTS, by_sport, unite, with_sport

__all__ = ["SPORTS", "by_sport", "functions", "operators", "plans", "sources", "streaming", "unite", "with_sport"]
