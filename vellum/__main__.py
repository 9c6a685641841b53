"""Run the text pipeline from the command line."""

from vellum.plans.pipeline import main

main()
