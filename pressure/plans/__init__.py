"""The jobs: clean, dimensions, facts, wins, marts, checks, and the build that runs them in order."""
