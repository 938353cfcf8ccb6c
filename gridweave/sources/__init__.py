"""gridweave.sources"""
