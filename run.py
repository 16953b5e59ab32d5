"""spark-submit entry point."""

from tapeworks.cli import main

if __name__ == "__main__":
    main()
