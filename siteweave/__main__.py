"""``python -m siteweave``."""

import sys

from siteweave.cli import main

sys.exit(main())
