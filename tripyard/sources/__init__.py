"""Sources: the raw monthly trip files and the test-table fixtures."""

from tripyard.sources.fixtures import fixture_raw_trips

__all__ = ["fixture_raw_trips"]
