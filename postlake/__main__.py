"""``python -m postlake <job> ...``"""

from .plans.jobs import main

main()
