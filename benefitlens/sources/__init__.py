from benefitlens.sources.tables import read_table, load_tables  # noqa: F401
from benefitlens.sources.fixtures import emp_raw, region_profile, fixture_tables  # noqa: F401
