import sys

from marlstone.plans.cli import main

sys.exit(main())
