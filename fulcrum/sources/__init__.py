from fulcrum.sources.model import Sources  # noqa: F401
from fulcrum.sources.raw import read_raw_csv, read_sources_csv  # noqa: F401
from fulcrum.sources.testdata import from_driver_tables  # noqa: F401
