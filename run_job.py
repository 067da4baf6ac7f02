"""Launcher for spark-submit; on a cluster ship the package with --py-files."""

from feedloom.jobs import main

if __name__ == "__main__":
    main()
