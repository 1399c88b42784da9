"""For spark-submit: spark-submit --py-files finmart.zip finmart_job.py <job> --lake <path>."""

from finmart.cli import main

if __name__ == "__main__":
    main()
