"""gridweave.streaming"""
