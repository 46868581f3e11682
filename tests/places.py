"""Where the test tables are."""

from pathlib import Path

TESTDATA = Path("/root/testdata")
