"""weftline.streaming"""
