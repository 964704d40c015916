import os
import sys

# Helpers of these tests, and those of the tests above them.
HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]
