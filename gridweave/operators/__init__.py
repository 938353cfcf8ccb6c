"""gridweave.operators"""
