"""Entry point for spark-submit; see ``wordloom.job``."""

from wordloom.job import main

if __name__ == "__main__":
    main()
