"""The command line."""

from .cli import main

main()
