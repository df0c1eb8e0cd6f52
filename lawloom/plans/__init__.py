from lawloom.plans.analyse import analyse, count_words
from lawloom.plans.clean import clean
from lawloom.plans.prepare import prepare, prepare_files

__all__ = ["analyse", "clean", "count_words", "prepare", "prepare_files"]
