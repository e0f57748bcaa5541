import sys

from casewatch.jobs import main

sys.exit(main())
