"""What the tests of the core share. (Not in conftest: every folder with tests may have a module of that name.)"""

SMALL = "/root/testdata/sf0.001"


def rows(df):
    """Order-insensitive comparable rows of a Spark DataFrame."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
