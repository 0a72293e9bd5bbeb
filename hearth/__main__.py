"""``python -m hearth`` runs the command line (see hearth/cli.py)."""

import sys

from hearth.cli import main

sys.exit(main())
